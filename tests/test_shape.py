"""Hot groups and plans: results equal plain Python, text moves once, no group gathers in one task."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palaver.functions.text import estimate_tokens
from palaver.operators import chunking, events, merge, prompts
from test_chunking import greedy

START = datetime(2024, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    """No automatic broadcast, many blocks, plans as written."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(frame):
    """The columns each shuffle of a plan moves."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"Exchange (hash|range|round)", line)], plan


# --- chunk texts --------------------------------------------------------------------------


@pytest.mark.parametrize("batch_rows", [7, 10_000])
@pytest.mark.parametrize("newest_first", [False, True])
def test_chunk_texts_of_a_hot_channel(spark, no_broadcast, newest_first, batch_rows):
    """Chunks across batches and blocks, blank messages at their edges, a null key."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        channel = 1 if i % 3 else rng.choice([None, 2, 3])
        words = rng.choice([0, 0, 1, 3, 8, 40])
        rows.append((channel, i, START + timedelta(seconds=i // 2), " ".join([f"w{i}"] * words) or " "))
    frame = spark.createDataFrame(rows, "channel_id int, message_id long, created_at timestamp_ntz, content string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = chunking.chunk_and_format(frame.repartition(6), ["channel_id"], 30, newest_first, include_timestamps=False)
        found = {(r.channel_id, r.chunk_no): r.text for r in got.collect()}
        first = chunking.chunk_and_format(frame, ["channel_id"], 30, newest_first, False, chunks=2)
        assert {(r.channel_id, r.chunk_no): r.text for r in first.collect()} == {k: v for k, v in found.items() if k[1] < 2}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    tokens = dict(frame.select("message_id", estimate_tokens(F.col("content"))).collect())
    expected = {}
    for channel in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == channel), key=lambda r: (r[2], r[1]), reverse=newest_first)
        for row, chunk in zip(own, greedy([tokens[r[1]] for r in own], 30), strict=True):
            lines = expected.setdefault((channel, chunk), [])
            if row[3].strip():
                lines.append(f"unknown: {row[3]}")
    assert found == {k: "\n".join(v) for k, v in expected.items()}


def test_chunk_texts_move_once(spark, no_broadcast):
    """Behind the sorted blocks only edge pieces are shuffled; before them one exchange sorts the lines."""
    rows = [(1, i, START, "word") for i in range(50)]
    frame = spark.createDataFrame(rows, "channel_id int, message_id long, created_at timestamp_ntz, content string")
    moved, plan = exchanges(chunking.chunk_and_format(frame, ["channel_id"], 30))
    with_text = [line for line in moved if "text" in line or "line" in line]
    filters = re.findall(r"Filter .*_whole", plan)
    assert "Join" not in plan.replace("BroadcastHashJoin", "")
    assert filters and len(with_text) <= 1


# --- users with many rows -------------------------------------------------------------------


def plain_changes(rows, stored):
    """(user, number, from, to) in arrival order."""
    out, names, numbers = [], dict(stored), {}
    for path, pos, user, name in sorted(rows):
        before = names.get(user)
        if before is not None and before != name:
            numbers[user] = numbers.get(user, 0) + 1
            out.append((user, numbers[user], before, name))
        names[user] = name
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_names_of_a_user_with_a_third_of_all_rows(spark, no_broadcast, seed):
    rng = random.Random(seed)
    rows = []
    for f in range(60):
        for pos in range(rng.randint(1, 12)):
            user = 7 if rng.random() < 0.34 else rng.randint(1, 40)
            rows.append((f"f{f:02d}", pos, user, rng.choice("abc") if user == 7 else rng.choice("ab")))
    stored = {7: "z", 3: "a", 999: "never seen", **({9: None} if seed else {})}
    frame = spark.createDataFrame(
        [(p, i, u, n, 1) for p, i, u, n in rows], "file_path string, pos int, discord_id long, username string, message_id long"
    ).repartition(7)
    known = spark.createDataFrame([(100 + u, u, n) for u, n in stored.items()], "user_id long, discord_id long, current_username string")
    ids = {u: 100 + u for u in stored}
    got = merge.username_changes(known, frame, START).collect()
    expected = [(ids.get(u, u), no, a, b) for u, no, a, b in plain_changes(rows, {u: n for u, n in stored.items() if n})]
    assert sorted((r.user_id, r.change_no, r.changed_from, r.username) for r in got) == sorted(expected)


def test_no_task_holds_the_hot_user(spark, no_broadcast):
    """The rows that each block holds: none above twice the median, though one user has most of them."""
    rows = [(f"f{i:04d}", 0, 7 if i % 10 else i, f"n{i % 5}", 1) for i in range(4000)]
    frame = spark.createDataFrame(rows, "file_path string, pos int, discord_id long, username string, message_id long")
    from palaver.operators.ordering import segments

    blocks, borders = segments(frame.repartition(8), "discord_id", ["file_path", "pos"])
    sizes = sorted(r["count"] for r in blocks.groupBy("_block").count().collect())
    assert len(sizes) == borders.count() >= 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert blocks.filter("discord_id = 7").select("_block").distinct().count() >= 4


def test_messages_of_a_hot_author_are_merged(spark, no_broadcast):
    """Text comes from the last arrival, all else from the first; equal to a plain fold."""
    rng = random.Random(5)
    schema = (
        "file_path string, pos int, server_id long, server_name string, channel_id long, channel_name string, "
        "message_id long, discord_id long, username string, created_at timestamp_ntz, edited_at timestamp_ntz, "
        "content string, reply_to_message_id long, thread_id long, reject string"
    )
    rows = [
        (f"f{rng.randint(0, 30):02d}", i, 1, "s", i % 4, "c", rng.randint(1, 300), 7 if i % 3 else i % 20, "n", START,
         START if i % 2 else None, f"text {i}", None, None, None)
        for i in range(900)
    ]
    users = spark.createDataFrame([(107, 7), (105, 5)], "user_id long, discord_id long")
    stored = [(m, 9, 9, "old", 55, f"stored {m}", START, None, None, True, None, None) for m in (1, 2, 1000)]
    kept = spark.createDataFrame(
        stored, "message_id long, server_id long, channel_id long, channel_name string, user_id long, content string, "
        "created_at timestamp_ntz, edited_at timestamp_ntz, deleted_at timestamp_ntz, is_deleted boolean, "
        "reply_to_message_id long, thread_id long",
    )
    got = merge.merge_messages(kept, users, spark.createDataFrame(rows, schema).repartition(5)).collect()
    expected = {r[0]: (r[1], r[2], r[4], r[5], r[7], True) for r in stored}
    arrived = {}
    for row in sorted(rows):
        arrived.setdefault(row[6], []).append(row)
    for number, own in arrived.items():
        first, last = own[0], own[-1]
        who = {7: 107, 5: 105}.get(first[7], first[7])
        place = (9, 9, 55) if number in (1, 2) else (first[2], first[4], who)
        expected[number] = (*place, last[11], last[10], False)
    assert {
        r.message_id: (r.server_id, r.channel_id, r.user_id, r.content, r.edited_at, r.is_deleted) for r in got
    } == expected


# --- batches and model answers ----------------------------------------------------------------


def test_numbering_moves_no_text(spark, no_broadcast):
    rows = [(i % 3, START, i, 0, f"title {i}", "", None, "talk", "long text " * 20) for i in range(95)]
    found = spark.createDataFrame(
        rows, "channel_rank int, created_at timestamp_ntz, message_id long, pos int, title string, date string, "
        "category string, source_channel string, raw_text string",
    )
    batches = prompts.event_batches(found.repartition(5))
    got = sorted((r.batch_no, r.batch_pos, r.message_id) for r in batches.collect())
    order = sorted(range(95), key=lambda i: (i % 3, i))
    assert got == [(n // 30, n % 30, i) for n, i in enumerate(order)]
    assert batches.columns == [*found.columns, "batch_no", "batch_pos"]
    # The prompts need no raw text, so it is not even read.
    _, plan = exchanges(prompts.event_batch_prompts(batches))
    assert "raw_text" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_answers_are_kept_when_a_run_breaks(spark, tmp_path):
    """A run that breaks half-way keeps the answers of ended tasks; the repeat asks for the rest only."""
    calls, broken = tmp_path / "calls", tmp_path / "broken"
    calls.mkdir()
    broken.touch()
    asked = [f"question {i}" for i in range(40)] + ["question 1", "bad", None]
    frame = spark.createDataFrame([(i, q) for i, q in enumerate(asked)], "id int, prompt string")
    folder, notes, mark = str(tmp_path / "answers"), str(calls), str(broken)

    def model(prompt):
        import os
        import time
        import uuid

        if prompt == "bad":
            time.sleep(2)  # the others have ended by then
            if os.path.exists(mark):
                raise RuntimeError("the model is down")
        with open(f"{notes}/{uuid.uuid4().hex}", "w") as note:
            note.write(prompt)
        return f" answer to {prompt} "

    def noted():
        return sorted(p.read_text() for p in calls.iterdir())

    with pytest.raises(Exception, match="the model is down"):
        prompts.apply_model(frame, model, answers=folder, calls_per_task=2)
    first = noted()
    assert len(first) >= 20 and len(set(first)) == len(first)
    broken.unlink()
    got = {r.id: r.answer for r in prompts.apply_model(frame, model, answers=folder, calls_per_task=2).collect()}
    assert got == {i: q and f"answer to {q}" for i, q in enumerate(asked)}
    # Each distinct prompt was asked again only if its task had not ended.
    assert set(noted()) == {q for q in asked if q} and len(noted()) <= 41 + 2
    third = prompts.apply_model(frame, model, answers=folder).count()
    assert third == len(asked) and len(noted()) <= 41 + 2


def test_failed_calls_are_asked_again(spark, tmp_path):
    frame = spark.createDataFrame([("a",), ("b",)], "prompt string")

    def failing(prompt):
        if prompt == "b":
            raise RuntimeError
        return "fine"

    folder = str(tmp_path / "answers")
    got = prompts.apply_model(frame, failing, on_error="none", answers=folder)
    assert dict(got.collect()) == {"a": "fine", "b": "none"}
    again = prompts.apply_model(frame, lambda prompt: "late", on_error="none", answers=folder)
    assert dict(again.collect()) == {"a": "fine", "b": "late"}


# --- event texts -------------------------------------------------------------------------------


def test_events_keep_whole_texts_unless_cut(spark):
    text = "**Long evening** " + "x" * 900
    frame = spark.createDataFrame([(1, "talk", text)], "message_id long, channel_name string, content string")
    assert events.extract_events(frame).first().raw_text == text
    assert events.extract_events(frame, raw_chars=500).first().raw_text == text[:500]
    post = "Game on monday at noon " + "y" * 900
    frame = spark.createDataFrame([(1, "talk", post)], "message_id long, channel_name string, content string")
    assert events.extract_sports(frame).first().raw_text == post
    assert events.extract_sports(frame, raw_chars=9).first().raw_text == post[:9]
