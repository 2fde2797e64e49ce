"""Substring operators against plain searches."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from palaver.llm import chunks, suffixes

LEAST = -(2**63)


def ident(doc_id):
    return LEAST if doc_id is None else doc_id


def naive(rows, width):
    """Kept bytes of each (doc_id, text), by looking at every window."""
    texts = sorted({(ident(i), (t or "").encode()) for i, t in rows}, key=lambda x: x[0])
    first = {}
    for doc_id, text in texts:
        for s in range(len(text) - width + 1):
            first[text[s : s + width]] = min(first.get(text[s : s + width], doc_id), doc_id)
    out = {}
    for doc_id, text in texts:
        gone, met = bytearray(len(text)), set()
        for s in range(len(text) - width + 1):
            window = text[s : s + width]
            if first[window] < doc_id or window in met:
                gone[s : s + width] = b"\1" * width
            met.add(window)
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id, text] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [4096, 1])
def test_suffixes_equal_a_plain_search(docs, corpus, group, monkeypatch):
    monkeypatch.setattr(suffixes, "STEP", 700)  # long texts are cut, borders fall anywhere
    found = suffixes.remove_repeats(docs, group=group).collect()
    expected = naive([(r[0], r[1]) for r in corpus], suffixes.WIDTH)
    wanted = Counter((r[0], *expected[ident(r[0]), (r[1] or "").encode()]) for r in corpus)
    assert Counter(map(tuple, found)) == wanted


def test_texts_move_once_for_small_and_large_groups(spark, corpus):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    rows = [(r[0], r[1]) for r in corpus]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).mapInArrow(counted, "doc_id long, text string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        assert len(suffixes.remove_repeats(docs, group=2).collect()) == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert reads.value == 2 * len(rows)  # for the runs, and for the exchange that both joins read


def test_a_window_of_a_large_group_that_many_share_travels_once(spark, monkeypatch):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(200)]
    sent = spark.sparkContext.accumulator(0)
    plain = suffixes._borders

    def counting(width):
        def run(batches):
            def told():
                for batch in batches:
                    sent.add(len(batch))
                    yield batch

            yield from plain(width)(told())

        return run

    monkeypatch.setattr(suffixes, "_borders", counting)
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), group=1).collect()
    expected = naive(rows, suffixes.WIDTH)
    assert {r[0]: tuple(r[1:]) for r in found} == {i: expected[i, t.encode()] for i, t in rows}
    assert 0 < sent.value < 200 * 60  # of some 57 windows a text, its 21 in the passage go as one span


def test_suffixes_of_few_letters(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) * rng.randint(1, 12)) for i in range(60)]
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width=40).collect()
    expected = naive(rows, 40)
    assert {r[0]: tuple(r[1:]) for r in found} == {i: expected[i, t.encode()] for i, t in rows}


def test_suffixes_of_nothing(empty):
    assert suffixes.remove_repeats(empty).collect() == []


def test_gear_is_a_window_hash():
    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    whole, tail = chunks.gear(data), chunks.gear(data[1000:])
    assert (whole[1000 + chunks.REACH :] == tail[chunks.REACH :]).all()


def test_cut_points_do_not_depend_on_steps(monkeypatch):
    data = np.random.default_rng(2).integers(97, 110, 20_000, dtype=np.uint8)
    whole = chunks.cut_points(data)
    monkeypatch.setattr(chunks, "STEP", 333)
    assert (chunks.cut_points(data) == whole).all()


def test_chunks_equal_a_plain_pass(docs, corpus):
    found = chunks.remove_repeats(docs).collect()
    expected = plain_chunks([(r[0], r[1]) for r in corpus])
    wanted = Counter((r[0], *expected[ident(r[0]), r[1] or ""]) for r in corpus)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_passages, r.kept_text) for r in found) == wanted


def test_chunks_do_not_depend_on_the_parts_of_a_batch(docs, corpus, monkeypatch):
    for name, size in (("STEP", 333), ("ROWS", 5), ("SENT", 900), ("CUT", 700)):
        monkeypatch.setattr(chunks, name, size)
    found = chunks.remove_repeats(docs.coalesce(1)).collect()
    expected = plain_chunks([(r[0], r[1]) for r in corpus])
    wanted = Counter((r[0], *expected[ident(r[0]), r[1] or ""]) for r in corpus)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_passages, r.kept_text) for r in found) == wanted


@pytest.mark.parametrize("rows", [6000, 1])
def test_chunk_tasks_hold_little_beside_a_large_batch(rows):
    size = 18_000_000 // rows
    letters = np.random.default_rng(23).integers(97, 123, rows * size, dtype=np.uint8).tobytes().decode()
    text = pa.array([letters[at : at + size] for at in range(0, len(letters), size)])
    ids, seen = pa.array(range(rows), pa.int64()), pa.nulls(rows, pa.list_(pa.int64()))
    sent = pa.RecordBatch.from_arrays([ids, text], names=["id", "text"])
    judged = pa.RecordBatch.from_arrays([text, seen, ids], names=["text", "seen", "row"])

    def most(run, batch):
        tracemalloc.start()
        try:
            assert sum(len(part) for part in run(iter([batch]))) >= rows
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    # Places and digests of a whole text are held, about 4 bytes for each of its own, and its kept text.
    limit = 70_000_000 if rows > 1 else 5 * len(letters)
    assert most(chunks._members, sent) < limit
    assert most(chunks._replace(chunks.LEAST), judged) < limit


def plain_chunks(rows):
    split = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        codes = np.frombuffer(data, np.uint8)
        inner = [c for c in chunks.cut_points(codes).tolist() if c >= chunks.REACH] if len(codes) else []
        cuts = sorted({0, len(data), *inner})
        split[ident(doc_id), text or ""] = [(a, b, data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    first = {}
    for (doc_id, _), parts in split.items():
        for _, _, part in parts:
            first[part] = min(first.get(part, doc_id), doc_id)
    out = {}
    for (doc_id, text), parts in split.items():
        met, gone = set(), []
        for a, b, part in parts:
            again = first[part] < doc_id or part in met
            met.add(part)
            if again and gone and gone[-1][1] == a:
                gone[-1][1] = b
            elif again:
                gone.append([a, b])
        data = text.encode()
        spans = []
        for a, b in gone:
            while a < b and data[a : a + 1] and data[a] & 0xC0 == 0x80:
                a += 1
            while b > a and data[b : b + 1] and data[b] & 0xC0 == 0x80:
                b -= 1
            if b - a >= chunks.LEAST:
                spans.append((a, b))
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        out[doc_id, text] = (len(data), sum(b - a for a, b in spans), len(spans), (kept + data[at:]).decode())
    return out


def test_shared_passages_go_and_clean_documents_stay(docs, corpus):
    found = {r.doc_id: r for r in chunks.remove_repeats(docs).collect()}
    assert all(found[i].n_removed > 200 for i in range(101, 106))
    assert all(found[i].n_removed == 0 for i in range(40))


def test_chunks_of_nothing(empty):
    assert chunks.remove_repeats(empty).collect() == []


def test_passages_of_the_promised_length_are_always_caught(spark):
    rng = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz   "

    def prose(n):
        return "".join(rng.choice(letters) for _ in range(n))

    size = chunks.always()
    assert size <= 290
    rows = []
    for i in range(400):
        passage = prose(size)
        rows += [(i, prose(rng.randrange(300)) + passage + prose(rng.randrange(300)))]
        rows += [(1000 + i, prose(rng.randrange(300)) + passage + prose(rng.randrange(300)))]
    found = chunks.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((r.n_passages, r.n_removed >= chunks.LEAST) == ((1, True) if r.doc_id >= 1000 else (0, False)) for r in found)


def test_no_inner_chunk_is_longer_than_a_window():
    data = np.random.default_rng(5).integers(97, 123, 50_000, dtype=np.uint8)
    assert np.diff(chunks.cut_points(data)).max() <= 48
