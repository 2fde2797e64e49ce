"""Texts move once: authors join narrow rows, and large keys are cut into parts that begin with a chunk."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY, with_author
from palaver.functions.text import estimate_tokens
from palaver.operators import chunking
from palaver.sources import fixtures
from palaver.sources.fixtures import bind
from test_chunking import greedy

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("part_tokens", [60, 900])
def test_parts_of_a_large_key(spark, monkeypatch, newest_first, part_tokens):
    """Many cuts, also where rows of one place stand on both sides of one."""
    monkeypatch.setattr(chunking, "PART_TOKENS", part_tokens)
    rng = random.Random(part_tokens)
    rows = []
    for i in range(2000):
        channel = 1 if i % 3 else rng.choice([None, 2, 3])
        at = rng.choice([None, START + timedelta(seconds=i // 3)])
        number = i // 2 if i % 50 < 6 else i
        rows.append((channel, number, at, " ".join([f"w{number}"] * rng.choice([0, 1, 3, 8, 40])) or " "))
    frame = spark.createDataFrame(rows, "k int, message_id long, created_at timestamp_ntz, content string")
    got = chunking.chunk_and_format(frame.repartition(5), ["k"], 30, newest_first, include_timestamps=False).collect()
    found = {(r.k, r.chunk_no): sorted(r.text.split("\n")) for r in got}
    assert len(found) == len(got)
    tokens = [r.n for r in frame.select(estimate_tokens(F.col("content")).alias("n")).collect()]
    expected = {}
    for key in (None, 1, 2, 3):
        mine = [(r, n) for r, n in zip(rows, tokens) if r[0] == key]
        mine.sort(key=lambda m: m[1])
        mine.sort(key=lambda m: (m[0][2] is None, m[0][2] or START, m[0][1]), reverse=newest_first)
        for (row, _), chunk in zip(mine, greedy([m[1] for m in mine], 30)):
            lines = expected.setdefault((key, chunk), [])
            if row[3].strip():
                lines.append(f"unknown: {row[3]}")
    assert found == {k: sorted(v) or [""] for k, v in expected.items()}


def small_tables(spark, folder):
    """Two users of one id, two documents of one id, an unknown user and a missing one."""
    at = START + timedelta(days=3)
    events = [(i, at, None if i % 7 == 0 else i % 5, "click") for i in range(60)]
    frames = {
        "events": spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string"),
        "customer": spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None)], "c_custkey long, c_name string"),
        "documents": spark.createDataFrame(
            [(0, "x"), (1, "y z"), (1, "w"), (2, None)], "doc_id long, text string"
        ),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return bind(spark, str(folder))


def test_authors_join_before_texts(spark, tmp_path):
    tables = small_tables(spark, tmp_path)
    names = tables.users.select("user_id", F.col("current_username").alias("author"))
    plain = tables.live_messages.join(names, "user_id")
    joined = with_author(tables)
    assert sorted(joined.columns) == sorted(plain.columns)
    rows = joined.select(*plain.columns)
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.splitlines() if "Join" in line)
    assert "doc_id" in last  # the texts come last, so no shuffle for the authors carries them


def test_spread_messages_are_the_live_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "SPREAD_BYTES", 1)
    tables = small_tables(spark, tmp_path)
    plain, spread = tables.live_messages, tables.live_spread()
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_texts_returned_with_each_title_are_written_small(spark, tmp_path, monkeypatch):
    """Texts beyond the reach of page compression, each in the result some fifty times."""
    monkeypatch.setattr(fixtures, "SPREAD_BYTES", 1 << 17, raising=False)
    rng = random.Random(7)
    marks = " ".join(f"**Title {i:04}**" for i in range(10))
    docs = [(i, marks + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=80_000))) for i in range(60)]
    events = [(i, START, 1, "click") for i in range(300)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    REGISTRY["extract_events"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/found")
    found = spark.read.parquet(f"{tmp_path}/found")
    assert found.agg(F.sum(F.length("raw_text"))).first()[0] > 200_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "found").glob("*.parquet")) < 30_000_000
