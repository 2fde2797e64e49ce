"""Lines on their way to their chunk: compressed, in parts of bounded size, and without leftovers of the first pass."""

import random
import time
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.functions import text
from palaver.functions.text import estimate_tokens
from palaver.operators import chunking, prompts
from test_chunking import greedy

START = datetime(2024, 1, 1)
SCHEMA = "k int, message_id long, created_at timestamp_ntz, content string"


def plain(text):
    return max(1, int(len(text.split()) * 1.3)) if text else 0


@pytest.mark.parametrize("window", [1, 7, 1 << 17])
def test_workers_count_words_like_the_expression(spark, monkeypatch, window):
    monkeypatch.setattr(text, "_COUNT_BYTES", window)
    rng = random.Random(window)
    letters = [*text.WHITESPACE_CHARS, *"abé—“​­中\U0001f600"]
    texts = [None, "", " ", "\x85", "a　b", *("".join(rng.choices(letters, k=rng.randint(0, 9))) for _ in range(400))]
    texts += [f"a{chr(c)}b c" for c in range(1, 0x3100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    expected = [r.n for r in frame.select("i", estimate_tokens(F.col("t")).alias("n")).orderBy("i").collect()]
    assert expected == [plain(t) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert text.token_counts(pa.array(texts, kind)).tolist() == expected
        assert text.token_counts(pa.array(texts, kind).slice(11)).tolist() == expected[11:]
    lines = pa.array([f"ann: {t.strip()}" if t and t.strip() else None for t in texts])
    filled = np.array([bool(t) for t in texts])
    assert text.token_counts(lines, np.full(len(texts), 5), filled).tolist() == expected
    assert text.token_counts(pa.array([], pa.string())).tolist() == []


def test_lines_are_moved_compressed(spark):
    """A task sends less than half of the text, and nothing but packed lines passes the exchange."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    lines = [" ".join(rng.choices(words, k=400)) for _ in range(600)]
    n = len(lines)
    batch = pa.RecordBatch.from_pydict({
        "k": pa.array([i % 3 for i in range(n)], pa.int32()), "_part": pa.array([0] * n, pa.int64()),
        "created_at": pa.array([START] * n, pa.timestamp("us")), "message_id": pa.array(range(n), pa.int64()),
        "_filled": pa.array([True] * n), "_lead": pa.array([0] * n, pa.int32()), "line": pa.array(lines),
    })
    schema = pa.schema([
        ("k", pa.int32()), ("_part", pa.int64()), ("created_at", pa.list_(pa.timestamp("us"))), ("message_id", pa.list_(pa.int64())),
        ("tokens", pa.list_(pa.int64())), ("size", pa.list_(pa.int32())), ("_raw", pa.int64()), ("_lines", pa.binary()),
    ])
    sent = list(chunking._shipper(["k"], schema)(iter([batch])))
    assert sum(b.num_rows for b in sent) == 3
    assert sum(b.nbytes for b in sent) < 0.5 * sum(map(len, lines))
    frame = spark.createDataFrame([(1, i, START, "word") for i in range(50)], SCHEMA)
    for texts in (
        chunking.chunk_and_format(frame, ["k"], 30),
        prompts.channel_faq_prompts(frame.withColumn("channel_name", F.lit("c")), ["k", "channel_name"], 30, author=None),
        prompts.factcheck_prompts(frame, ["k"], "topic", 30, author=None),
    ):
        plan = texts._jdf.queryExecution().optimizedPlan().toString().splitlines()
        moved = [line for line in plan if "RepartitionByExpression" in line]
        assert moved and all("_part" in line for line in moved)
        assert "_lines#" in next(line for line in plan[plan.index(moved[0]) :] if "MapInArrow" in line)


@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("part_bytes, piece_bytes, held_bytes", [(3_000, 1 << 24, 1 << 26), (1, 150, 1), (1 << 25, 1, 4_000)])
def test_parts_and_pieces_of_few_bytes(spark, monkeypatch, newest_first, part_bytes, piece_bytes, held_bytes):
    """Long words count few tokens, so parts end by their bytes; chunks with much text leave in pieces."""
    for name, value in (("PART_BYTES", part_bytes), ("PIECE_BYTES", piece_bytes), ("HELD_BYTES", held_bytes)):
        monkeypatch.setattr(chunking, name, value, raising=False)
    rng = random.Random(part_bytes)
    rows = []
    for i in range(900):
        content = rng.choice([None, "", " ", f"w{i} é", f"{i}" + "x" * rng.randint(50, 400), " ".join([f"v{i}"] * 50)])
        at = None if i % 90 == 5 else START + timedelta(seconds=i // 2)
        rows.append((rng.choice([None, 1, 2, 2, 2]), None if i % 91 == 7 else i, at, content))
    frame = spark.createDataFrame(rows, SCHEMA)
    got = chunking.chunk_and_format(frame.repartition(5), ["k"], 30, newest_first, include_timestamps=False).collect()
    found = {(r.k, r.chunk_no): r.text for r in got}
    assert len(found) == len(got)
    expected = {}
    for key in (None, 1, 2):
        mine = [r for r in rows if r[0] == key]
        # Unknown times are the newest, unknown ids the smallest.
        mine.sort(key=lambda r: (r[2] is None, r[2] or START, r[1] is not None, r[1] or 0), reverse=newest_first)
        for row, chunk in zip(mine, greedy([plain(r[3]) for r in mine], 30), strict=True):
            lines = expected.setdefault((key, chunk), [])
            if row[3] and row[3].strip():
                lines.append(f"unknown: {row[3].strip()}")
    assert found == {k: "\n".join(v) for k, v in expected.items()}
    if part_bytes < 10_000:
        chunked = chunking._chunked(frame, ["k"], 30, newest_first)
        cuts = {r.k: len(r._cuts) for r in chunking._cuts(chunked, ["k"], 1000, newest_first).collect()}
        assert cuts[2] > 10


def test_first_pass_leaves_no_shuffle_files(spark):
    """The pass that finds the chunks is over before lines move; its files must not lie beside theirs."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        return {f for f in (str(x) for x in disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}

    rows = [(i % 3, i, START, "one two three") for i in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, known = spark.conf.get(setting), files()
    chunking.chunk_and_format(frame.repartition(7, "message_id"), ["k"], 30)
    until = time.time() + 20
    while files() - known and time.time() < until:
        time.sleep(0.2)
    assert files() - known == set()
    assert spark.conf.get(setting) == before
