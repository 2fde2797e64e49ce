"""Signatures find what the plain search finds; cue words by their shared parts; events cut out of texts once."""

import pytest
from pyspark.sql import functions as F

from checks import queries
from palaver.functions import events as ev
from palaver.operators import search
from palaver.sources.fixtures import bind
from palaver.sources.tables import contains_ilike
from test_texts import small_tables

TEXTS = ["Hack Night 1", "hack", "NIGHT", "a\u00e9\U0001f550b", "ab", "", None, "ght 1", "xyz" * 700, "\u0130ght"]


@pytest.mark.parametrize("term", ["night", "N_ght 1%", "ab", "\u00e9\U0001f550b", "zxy", "ght 1", "nothing"])
def test_signatures_choose_all_matches(spark, term):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "message_id long, content string").repartition(3)
    matches = contains_ilike(F.col("content"), term)
    index = search.signatures(frame)
    assert index.filter(F.size("signature") != search.SIGNATURE_BITS // 64).count() == 0
    chosen = search.chosen_by_signature(frame, index, term)
    found = {r.message_id for r in chosen.filter(matches).collect()}
    assert found == {r.message_id for r in frame.filter(matches).collect()}


def test_signatures_are_selective(spark):
    frame = spark.createDataFrame([(i, f"message of number {i * 7919}") for i in range(500)], "message_id long, content string")
    assert search.signed_ids(search.signatures(frame), ["zzq", "qqz"]).count() < 25


def test_repeated_ids_are_chosen_as_by_postings(spark):
    rows = [(1, "a night"), (1, "a night"), (2, "night"), (2, "other"), (3, "night")]
    frame = spark.createDataFrame(rows, "message_id long, content string")
    by_postings = search.chosen_messages(frame, search.postings(frame), "night")
    by_signature = search.chosen_by_signature(frame, search.signatures(frame), "night")
    assert sorted(by_signature.collect()) == sorted(by_postings.collect())


def test_every_cue_word_counts(spark):
    cues = [*ev.PLACE_CUES, *ev.DAY_CUES, *ev.CLOCK_CUES]
    texts = [(f"we meet {cue.upper()} or so", True) for cue in cues]
    texts += [("we meet some day", False), ("\U0001f56b", False), ("\u00f6", False), ("", False), (None, None)]
    frame = spark.createDataFrame(texts, "content string, cue boolean")
    assert frame.filter(~ev.has_cue(F.col("content")).eqNullSafe(F.col("cue"))).collect() == []


def test_batches_read_no_text_again(spark, tmp_path):
    small_tables(spark, tmp_path)
    batches = queries._batches(bind(spark, str(tmp_path)))
    assert "parquet" not in batches._jdf.queryExecution().executedPlan().toString().lower()
    assert batches.count() > 0
