"""Stages of the pipeline on tables whose further columns have any names, helper names among them."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from palaver.llm import chunks, mixing, quality, simhash

FOLDER = Path(chunks.__file__).parent


def helper_names():
    """Every quoted plain word of the stages' modules and of what they share: column names of theirs are among them."""
    words = set()
    for name in ("chunks", "common", "mixing", "quality", "repeats", "simhash"):
        words |= set(re.findall(r"""["'](_?[a-z][a-z0-9_]*)["']""", (FOLDER / f"{name}.py").read_text()))
    return sorted(words - {"doc_id", "text", "lang", "source", "n_chars"})


ROWS = [
    (1, "one common passage of many words that both of these documents hold, long enough to go " * 3 + "alpha beta", "en", "a"),
    (2, "gamma delta " + "one common passage of many words that both of these documents hold, long enough to go " * 3, "en", "b"),
    (3, "x y z", "en", "a"), (4, "x y z", None, None), (None, None, None, "a"), (5, "", "fr", "b"),
    (6, " ".join(f"word{i} is here" for i in range(60)), "en", "a"), (6, " ".join(f"word{i} is here" for i in range(60)), "en", "a"),
]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars int")


def values(frame, columns):
    return sorted((repr([r[c] for c in columns]) for r in frame.collect()))


@pytest.mark.parametrize("stage", [quality.keep, simhash.one_of_each, chunks.without_repeats, mixing.repeated])
def test_helper_names_as_columns(plain, stage):
    """All helper names at once: the same rows as without them, and the columns come back unchanged."""
    names = [*helper_names(), "a.b", "with space"]
    wide = plain.selectExpr("*", *[f"concat('{name} ', doc_id) AS `{name}`" for name in names])
    got = stage(wide)
    assert got.columns == wide.columns and [f.dataType for f in got.schema] == [f.dataType for f in wide.schema]
    assert values(got, plain.columns) == values(stage(plain), plain.columns)
    for row in got.collect():
        for name in names:
            assert row[name] == (None if row.doc_id is None else f"{name} {row.doc_id}")


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "mixing", "best_fit_packing",
    ]
