"""Token estimate, chunk packing and formatting against a few lines of plain Python."""

import random
import subprocess
import sys
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palaver.functions.text import estimate_tokens, format_line, strip
from palaver.operators import chunking

START = datetime(2024, 1, 1)


def greedy(tokens, budget):
    chunk, fill, numbers = 0, 0, []
    for i, t in enumerate(tokens):
        if i and fill + t > budget and numbers:
            chunk, fill = chunk + 1, 0
        fill += t
        numbers.append(chunk)
    return numbers


token_lists = st.lists(st.integers(0, 14), min_size=1, max_size=60)


@settings(max_examples=400, deadline=None)
@given(token_lists, st.lists(st.integers(1, 59), max_size=6), st.integers(1, 12))
def test_blocks_pack_like_one_fold(tokens, cuts, budget):
    edges = sorted({0, len(tokens), *[c for c in cuts if c < len(tokens)]})
    blocks = [np.array(tokens[a:b]) for a, b in zip(edges, edges[1:])]
    fill, new = (r[0] for r in chunking._report(blocks[0], budget, fresh=True)[2:])
    numbers, leaving = chunking._pack(blocks[0], None, budget)
    assert leaving == (fill, new)
    result, state = list(numbers), (fill, new)
    for block in blocks[1:]:
        numbers, leaving = chunking._pack(block, state, budget)
        fill, new = chunking._apply_report(
            state[0], chunking._report(block, budget, fresh=False), budget
        )
        state = (fill, state[1] + new)
        assert leaving == state
        result += list(numbers)
    assert result == greedy(tokens, budget)


@pytest.mark.parametrize("newest_first", [False, True])
def test_hot_channel_spans_partitions(spark, newest_first):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        channel = 1 if i % 3 else rng.choice([None, 2, 3, 4])
        words = rng.choice([0, 1, 3, 8, 40, 90])
        rows.append((channel, i, START + timedelta(seconds=i // 2), " ".join(["w"] * words)))
    frame = spark.createDataFrame(
        rows, "channel long, message_id long, created_at timestamp_ntz, content string"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chunking.chunk_messages(
            frame, ["channel"], max_tokens=100, newest_first=newest_first
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {(r.channel, r.message_id): r.chunk_no for r in got}
    assert len(got) == len(rows)
    for channel in (None, 1, 2, 3, 4):
        mine = [r for r in rows if r[0] == channel]
        mine.sort(key=lambda r: (r[2], r[1]), reverse=newest_first)
        tokens = [max(1, int(len(r[3].split()) * 1.3)) if r[3] else 0 for r in mine]
        assert [got[channel, r[1]] for r in mine] == greedy(tokens, 100)


def test_edges(spark):
    def pack(*contents, budget=10):
        rows = [(1, i, START, c) for i, c in enumerate(contents)]
        frame = spark.createDataFrame(
            rows, "k long, message_id long, created_at timestamp_ntz, content string"
        )
        got = chunking.chunk_messages(frame, ["k"], budget).orderBy("message_id").collect()
        return [r.chunk_no for r in got]

    big = " ".join(["w"] * 20)
    assert pack() == []
    assert pack(big, "a", "b") == [0, 1, 1]
    assert pack("a", big, "b") == [0, 1, 2]
    assert pack(big, "", "a") == [0, 1, 1]
    assert pack(*["w w w w"] * 3) == [0, 0, 1]
    assert pack(None, "", " ") == [0, 0, 0]


def test_estimate_tokens_and_strip(spark):
    texts = [None, "", " ", "\x1c", "one", "a b　c", "a\x1fb\x0bc\x85d", "x " * 999]
    texts += [f"a{chr(c)}b c" for c in range(1, 0x3100)]
    texts += ["​zero width", " ".join("w" for _ in range(10)), " a "]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = frame.select(
        "i", estimate_tokens(F.col("t")).alias("n"), strip(F.col("t")).alias("s")
    ).collect()
    for row in rows:
        text = texts[row.i]
        assert row.n == (max(1, int(len(text.split()) * 1.3)) if text else 0)
        assert row.s == (text.strip() if text is not None else None)


def test_format_lines_and_blank_chunk(spark):
    rows = [
        (1, 1, START, "  hi there \n", "ann"),
        (1, 2, START, "  ", "bob"),
        (1, 3, None, "later", ""),
        (2, 4, START, "", "ann"),
    ]
    frame = spark.createDataFrame(
        rows, "k long, message_id long, created_at timestamp_ntz, content string, author string"
    )
    lines = frame.select(
        "message_id", format_line(F.col("content"), F.col("created_at"), F.col("author"))
    ).collect()
    assert dict(map(tuple, lines)) == {
        1: "[2024-01-01 00:00] ann: hi there",
        2: None,
        3: "unknown: later",
        4: None,
    }
    texts = chunking.chunk_and_format(frame, ["k"], author="author").collect()
    assert {(r.k, r.chunk_no): r.text for r in texts} == {
        (1, 0): "[2024-01-01 00:00] ann: hi there\nunknown: later",
        (2, 0): "",
    }
    plain = chunking.chunk_and_format(frame, ["k"], include_timestamps=False).collect()
    assert plain and "[" not in plain[0].text


def test_chunk_stats(spark):
    frame = spark.createDataFrame([("a b c",), ("",), (None,), ("x",)], "content string")
    assert tuple(chunking.chunk_stats(frame).first()) == (4, 4, 1, 1.0)
    assert tuple(chunking.chunk_stats(frame.limit(0)).first()) == (0, 0, 0, 0.0)
    halves = spark.createDataFrame([("a",)] + [("",)] * 3, "content string")
    assert chunking.chunk_stats(halves).first().avg_tokens_per_message == 0.2


def test_task_functions_travel_with_the_job(tmp_path):
    import pyarrow as pa
    from pyspark import cloudpickle

    schema = pa.schema([("k", pa.int64()), ("chunk_no", pa.int64())])
    blob = tmp_path / "task"
    blob.write_bytes(cloudpickle.dumps(chunking._packer(["k"], schema, 10)))
    load = "import pickle, sys; print(pickle.load(open(sys.argv[1], 'rb')).__name__)"
    done = subprocess.run(
        [sys.executable, "-c", load, str(blob)], cwd=tmp_path, capture_output=True, text=True
    )
    assert done.stdout.strip() == "run", done.stderr
