"""Fingerprints, trie join and components against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from palaver.llm import simhash


def plain_fingerprint(text, shingle=3):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, budget):
    """prints: (id, fp) -> smallest id reachable for each fp."""
    values = sorted({fp for _, fp in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                parent[root(a)] = root(b)
    least = {}
    for doc_id, fp in prints:
        key = -(2**63) if doc_id is None else doc_id
        least[root(fp)] = min(least.get(root(fp), key), key)
    return {v: least[root(v)] for v in values}


def test_near_duplicates_equal_all_pairs(docs, corpus):
    found = simhash.near_duplicates(docs).collect()
    prints = [(r[0], plain_fingerprint(r[1] or "")) for r in corpus]
    least = plain_components(prints, 2)
    wanted = Counter((i, fp - (1 << 64) if fp >> 63 else fp, None if least[fp] == -(2**63) else least[fp]) for i, fp in prints)
    assert Counter(map(tuple, found)) == wanted


def test_links_with_splits_equal_all_pairs(spark):
    rng = random.Random(4)
    values = {rng.getrandbits(64) for _ in range(300)}
    for center in list(values)[:3]:  # dense clusters: large tries
        for _ in range(250):
            value = center
            for _ in range(rng.randint(1, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fp long")
    for budget, group in ((2, 20_000), (2, 20), (6, 20_000), (6, 50)):
        edges = simhash.links(prints.select("fp"), budget, group=group)
        roots = {r.node: r.root for r in simhash.components(edges).collect()}
        expected = plain_components([(i, v & (2**64 - 1)) for i, v in enumerate(signed)], budget)
        ours = {}
        for i, v in enumerate(signed):
            ours.setdefault(roots.get(v, v), []).append(i)
        theirs = {}
        for i, v in enumerate(signed):
            theirs.setdefault(expected[v & (2**64 - 1)], []).append(i)
        assert sorted(map(tuple, ours.values())) == sorted(map(tuple, theirs.values())), (budget, group)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 499)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 500: 499}


def test_nothing(empty):
    assert simhash.near_duplicates(empty).collect() == []


def test_long_text_in_parts(monkeypatch):
    text = " ".join(str(i) for i in range(999))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 10)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)
    assert np.uint64(whole) == whole


def plain_kept(rows, budget=2):
    """Of each component of all pairs within the budget, the smallest id."""
    prints = [plain_fingerprint(text or "") for _, text in rows]
    roots = plain_components(list(enumerate(prints)), budget)
    least = {}
    for (doc_id, _), fp in zip(rows, prints, strict=True):
        key = -(2**63) if doc_id is None else doc_id
        least[roots[fp]] = min(least.get(roots[fp], key), key)
    return sorted(least.values())


def test_one_of_each_equals_all_pairs(spark, docs, corpus):
    rows = [(r[0], r[1]) for r in corpus]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    found = [(-(2**63) if r.doc_id is None else r.doc_id) for r in kept.collect()]
    assert sorted(found) == plain_kept(rows)


def test_one_of_each_of_long_near_copies(spark):
    """Long texts with one word changed, chains of them, and repeated rows under one id."""
    rng = random.Random(21)
    rows = []
    for _ in range(30):
        words = [f"w{rng.randrange(50_000)}" for _ in range(400)]
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(400)] = f"odd{rng.randrange(10**6)}"
    rows += [rows[3], rows[3], (3, "another text under the same id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(r.doc_id for r in simhash.one_of_each(frame).collect())
    assert found == plain_kept(rows) and len(found) < len(rows) - 20


@pytest.mark.parametrize("name", ["own", "text_hash", "row", "turn", "fp", "first", "root", "_own", "_hash", "_turn", "node", "a.b"])
def test_one_of_each_with_any_column(spark, name):
    frame = spark.createDataFrame([(1, "x y z", "kept"), (2, "x y z", "gone")], f"doc_id long, text string, `{name}` string")
    assert [tuple(r) for r in simhash.one_of_each(frame).collect()] == [(1, "x y z", "kept")]
    assert simhash.one_of_each(frame.limit(0)).collect() == []


def test_large_group_becomes_stars(monkeypatch):
    monkeypatch.setattr(simhash, "SETTLE", 500)
    rng = np.random.default_rng(3)
    center = rng.integers(0, 2**48, 1, np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 40, (3000, 3)).astype(np.uint64)).astype(np.uint64)
    values = np.unique(center ^ np.bitwise_xor.reduce(flips, axis=1))
    zeros = np.zeros(len(values), np.int64)
    x, y = simhash.trie_pairs(values, zeros, zeros, zeros, 16, 6)
    nodes, roots = simhash.forest(x, y)
    assert set(roots.tolist()) == {0} and len(nodes) == len(values) - 1
    assert len(x) < 200_000
