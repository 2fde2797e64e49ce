import random

import pytest
from pyspark.sql import functions as F

from palaver.llm import tokencounts
from palaver.llm.common import table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokencounts.tokenizer_path())


def plain(tokenizer, rows, limit=1024):
    out = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def rows(frame):
    assert frame.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted(map(tuple, frame.collect()), key=repr)


def test_equals_the_library_on_odd_documents(docs, corpus, tokenizer):
    assert rows(tokencounts.count_tokens(docs)) == plain(tokenizer, [(r[0], r[1]) for r in corpus])


@pytest.mark.parametrize("given", [{}, {" the": 1, "x": 1}])
def test_the_table_changes_no_count(docs, corpus, tokenizer, given):
    assert rows(tokencounts.count_tokens(docs, table=given)) == plain(tokenizer, [(r[0], r[1]) for r in corpus])


def test_empty(empty):
    assert rows(tokencounts.count_tokens(empty)) == []


def test_strings_of_odd_characters(spark, tokenizer):
    """Spaces of all kinds, contractions, special strings, letters and numbers beyond the plain classes."""
    rng = random.Random(4)
    alphabet = list("ab  \n\t'srevl1.,!<|>\x1c\x85\xa0é½²ªÀßſ…—“€ 　漢ß😀ͅ\x00​")
    alphabet += ["<|endoftext|>", " 's", "'ll", "''", "'RE"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(tokencounts.count_tokens(frame)) == plain(tokenizer, list(enumerate(texts)))


def test_plain_classes_are_those_of_the_library(tokenizer):
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    for point in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        c = chr(point)
        for text in (f"a{c}b", f" {c}{c} 1{c}!", f"{c} {c}  x"):
            assert tokencounts._OTHER.search(text) is None
            assert tokencounts._PLAIN.findall(text) == [text[a:b] for _, (a, b) in split(text)], hex(point)


def test_long_texts_are_counted_in_stretches(tokenizer):
    rng = random.Random(6)
    text = "".join(rng.choice(["word ", "a  b", "\n\n x", "it's ", "é ", "1 2 "]) for _ in range(3000))
    parts = list(tokencounts.stretches(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    lengths = tokencounts.Lengths(tokencounts.tokenizer_path(), {})
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert sum(lengths._sum(lengths.pieces(part)) for part in parts) == whole
    assert list(tokencounts.stretches("x" * 500, 100)) == ["x" * 500]


def test_a_full_cache_is_emptied(monkeypatch, tokenizer):
    monkeypatch.setattr(tokencounts, "CACHE_ENTRIES", 5)
    lengths = tokencounts.Lengths(tokencounts.tokenizer_path(), {" a": 1})
    for n in range(50):
        text = f"word{n} and {n * 977} more {n}"
        assert lengths.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert len(lengths.known) <= 6


def test_table_is_bounded(spark, docs):
    found = tokencounts.frequent_lengths(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), tokencounts.tokenizer_path(), entries=20)
    assert len(found) == 20 and all(len(piece.encode()) <= tokencounts.PIECE_BYTES for piece in found)


def test_registered_table_equals_the_library(spark, tokenizer):
    found = table(spark, "/root/testdata/sf0.001", "documents")
    expected = plain(tokenizer, [(r.doc_id, r.text) for r in found.collect()])
    assert rows(tokencounts.count_tokens(found)) == expected
