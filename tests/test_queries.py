"""Traps of the library queries and the weekly job on tiny rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.text import contains_ilike, fill_template, like_pattern
from palaver.operators import prompts, queries, weekly
from palaver.operators.ordering import number_rows, top_per_group
from palaver.plans import analysis_report, weekly_report
from palaver.sources import tables as src
from palaver.sources.tables import Tables

AS_OF = datetime(2024, 1, 31)
DAY = timedelta(days=1)


def post(id, server=1, user=1, text="hi", at=AS_OF - DAY, channel="talk", deleted=False, thread=None):
    return (id, server, server * 10, channel, user, text, at, None, None, deleted, None, thread)


def build(spark, messages=(), users=((1, "ann"), (2, "bob"), (3, "Deleted User 9")), servers=((1, "Home"), (2, "Idle")), members=(), reactions=(), history=()):
    rows = {
        "messages": list(messages),
        "users": [(u, u + 100, name, at[0] if at else AS_OF - 90 * DAY, AS_OF) for u, name, *at in users],
        "servers": [(s, name, None, AS_OF, True) for s, name in servers],
        "server_members": list(members),
        "reactions": [(i, m, "x", 1, AS_OF) for i, m in enumerate(reactions)],
        "username_history": list(history),
    }
    return Tables(lambda name: spark.createDataFrame(rows[name], schemas.TABLES[name]))


def rows(frame, *columns):
    return [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]


def test_like_terms(spark):
    assert like_pattern("a\\qb") == "%aqb%"
    assert like_pattern("50\\%") == "%50\\%%"
    frame = spark.createDataFrame([("100% SURE",), ("a_b",), ("axb",), ("a\\b",), (None,)], "t string")

    def hits(term):
        return [r[0] for r in frame.filter(contains_ilike(F.col("t"), term)).collect()]

    assert hits("sure") == ["100% SURE"]
    assert hits("A_B") == ["a_b", "axb", "a\\b"]
    assert hits("a\\_b") == ["a_b"]
    assert hits("\\s\\u") == ["100% SURE"]
    assert hits("\\\\") == ["a\\b"]
    assert hits("") == ["100% SURE", "a_b", "axb", "a\\b"]


def test_null_server_name_is_kept_last(spark):
    members = [(s, 1, AS_OF, None, True) for s in (1, 2, 3)] + [(1, 2, AS_OF, None, False)]
    tables = build(spark, servers=((1, "b"), (2, None), (3, "a")), members=members)
    assert rows(queries.users_across_servers(tables, 3)) == [(101, "ann", 3, ["a", "b", None])]
    assert rows(queries.users_across_servers(tables, 4)) == []


def test_health_counts_returned_members(spark):
    members = [(1, 1, datetime(2024, 1, 5), datetime(2024, 2, 9), True), (1, 2, datetime(2024, 1, 6), None, True)]
    got = rows(queries.server_health(build(spark, members=members), 1), "new_members", "left_members", "net_change")
    assert got == [(0, 1, -1), (2, 0, 2)]


def test_context_and_window_edge(spark):
    messages = [
        post(1, at=AS_OF - 7 * DAY), post(2, at=AS_OF - 7 * DAY + timedelta(microseconds=1)),
        post(3, at=AS_OF + DAY), post(4, deleted=True), post(5, server=9),
    ]
    tables = build(spark, messages, reactions=[2, 2, 4, 99])
    got = rows(queries.user_message_context(tables, AS_OF, 1, 7), "message_id", "reaction_count")
    assert got == [(3, 0), (2, 2)]
    assert queries.server_summary(tables, AS_OF, 2).isEmpty()


def test_ties_are_ordered(spark):
    tables = build(spark, [post(1, user=2), post(2, user=1), post(3, user=3)])
    assert rows(queries.recent_active_users(tables, AS_OF, 1, limit=2), "user_id") == [(1,), (2,)]
    assert rows(weekly.top_users_per_server(tables, AS_OF, limit=1), "current_username") == [("ann",)]


def test_idle_server_and_same_names(spark):
    tables = build(
        spark, [post(1), post(2, thread=10), post(3, server=3, deleted=True), post(4, server=2)],
        servers=((1, "Home"), (2, "Home"), (3, "Quiet")),
    )
    assert rows(weekly.server_stats(tables, AS_OF)) == [
        (1, "Home", 2, 1, 1, 1), (2, "Home", 1, 1, 1, 0), (3, "Quiet", 0, 0, 0, 0),
    ]
    assert rows(weekly.server_stats(tables, AS_OF, server_id=3), "server_id") == [(3,)]
    assert rows(weekly.weekly_trends(tables, AS_OF), "server_name", "posts", "unique_users") == [("Home", 3, 1)]
    assert rows(weekly.weekly_trends(tables, AS_OF, by_name=False), "server_id", "posts") == [(1, 2), (2, 1)]
    nested = rows(weekly.server_stats_nested(tables, AS_OF).filter("server_id = 3"), "new_users", "top_users")
    assert nested == [(0, [])]


def test_new_users_count_any_message(spark):
    users = ((1, "old", AS_OF - 30 * DAY), (2, "new", AS_OF - DAY), (3, "newer", AS_OF - DAY))
    messages = [post(1, user=1), post(2, user=2, deleted=True), post(3, user=3, at=AS_OF - 300 * DAY)]
    tables = build(spark, messages, users=users)
    assert rows(weekly.new_users_per_server(tables, AS_OF)) == [(1, 2)]


def test_links(spark):
    users = ((1, "ann", AS_OF - 3 * DAY), (3, "Deleted User 9", AS_OF - 300 * DAY), (4, "future", AS_OF))
    messages = [
        post(1, text="see https://bit.ly/a and http://x.y/b. BIT.LY"),
        post(2, text="tinyurl alone is no link"),
        post(3, text="tinyurl https://example.org/q"),
        post(4, user=3, at=AS_OF - 400 * DAY, text="<https://docs.google.com/d/1>"),
        post(5, user=4, text="https://shorturl.at/zz"),
        post(6, user=3, text="https://bit.ly/gone", deleted=True),
    ]
    tables = build(spark, messages, users=users)
    assert rows(weekly.shortlinks(tables, AS_OF), "url") == [("https://shorturl.at/zz",), ("https://bit.ly/a",)]
    assert rows(weekly.links_deleted_accounts(tables), "url") == [("https://docs.google.com/d/1",)]
    assert rows(weekly.links_new_accounts(tables, AS_OF), "url") == [
        ("https://shorturl.at/zz",), ("https://example.org/q",), ("https://bit.ly/a",), ("http://x.y/b.",),
    ]
    assert dict(rows(weekly.security_summary(tables, AS_OF))) == {
        "deleted_account_links": 1, "shortlinks": 2, "new_account_links": 4, "total": 7,
    }
    assert weekly.security_summary(build(spark), AS_OF).count() == 4


def test_bounds_are_strict(spark):
    tables = build(spark, [post(i, at=AS_OF + i * DAY) for i in range(1, 5)])
    got = src.export_bounds(tables.messages, AS_OF + DAY, AS_OF + 4 * DAY)
    assert rows(got, "message_id") == [(2,), (3,)]
    assert rows(src.export_bounds(tables.messages, 1, 4), "message_id") == [(2,), (3,)]
    assert src.select_scope(tables.messages, [2]).isEmpty()


def test_name_at_a_time(spark):
    history = [(1, "B", "A", datetime(2024, 1, 5), 1), (1, "C", "B", datetime(2024, 1, 9), 1)]
    tables = build(spark, history=history)
    at = datetime(2024, 1, 6)
    assert rows(queries.username_lookup(tables, "B", at), "user_id") == [(1,)]
    assert rows(queries.username_lookup(tables, "A", at), "user_id") == []
    assert rows(queries.username_lookup(tables, "A"), "user_id") == [(1,)]


def test_names_of_one_load_keep_their_order(spark):
    at = datetime(2024, 1, 5)
    history = [(1, "A", "B", at, 2), (1, "B", "A", at, 1)]
    tables = build(spark, history=history)
    now = datetime(2024, 1, 20)
    assert rows(queries.username_lookup(tables, "A", now), "user_id") == [(1,)]
    assert rows(queries.username_lookup(tables, "B", now), "user_id") == []
    assert rows(queries.username_lookup(tables, "A", datetime(2024, 1, 1)), "user_id") == [(1,)]


def test_templates_fill_in_order(spark):
    frame = spark.createDataFrame([("{b} {x}", "struct { int x; }")], "a string, b string")
    text = fill_template("{a}|{b}", {"a": F.col("a"), "b": F.col("b")})
    assert frame.select(text).first()[0] == "struct { int x; } {x}|struct { int x; }"


@pytest.mark.parametrize("salt", [None, "i"])
def test_top_per_group_and_numbering(spark, salt):
    frame = spark.range(1000).select(F.col("id").alias("i"), (F.col("id") % 3 == 0).alias("k"))
    top = top_per_group(frame, ["k"], [F.desc("i")], 5, salt_on=salt)
    best = {k: sorted((r.i for r in top.collect() if r.k == k), reverse=True) for k in (True, False)}
    assert best == {True: [999, 996, 993, 990, 987], False: [998, 997, 995, 994, 992]}
    numbered = number_rows(frame.repartition(7), ["k", "i"]).orderBy("row_no").collect()
    assert [r.row_no for r in numbered] == list(range(1000))
    assert [(r.k, r.i) for r in numbered] == sorted((r.k, r.i) for r in numbered)


def test_labels(spark):
    batches = spark.createDataFrame(
        [(b, p, None) for b in range(5) for p in range(3)], "batch_no long, batch_pos int, category string"
    )
    answers = spark.createDataFrame(
        [
            (0, ' ```json\n[{"category": "tech"}, {"category": "art"}]\n``` '),
            (1, '[{"category":"a"},{"category":"b"},{"category":"c"},{"category":"d"}]'),
            (2, "sorry"), (3, '[{"title": "no label"}, {"category": "x"}, null]'), (4, ""),
        ],
        "batch_no long, answer string",
    )

    def labels(allowed=None):
        got = prompts.parse_labels(batches, answers, allowed).orderBy("batch_no", "batch_pos").collect()
        return [[r.category for r in got if r.batch_no == b] for b in range(5)]

    other = ["other"] * 3
    assert labels() == [["tech", "art", "other"], ["a", "b", "c"], other, ["other", "x", "other"], other]
    assert labels(prompts.CATEGORIES) == [["tech", "other", "other"], other, other, other, other]


def test_prompts(spark):
    messages = [post(i, user=1, at=AS_OF - DAY * i, text=f"word{i}") for i in (1, 2)]
    messages += [post(3, user=2, text="  "), post(4, server=2, user=1, text="elsewhere")]
    tables = build(spark, messages)
    story = {r.user_id: r.prompt for r in prompts.user_story_prompts(tables, AS_OF, 1).collect()}
    assert "unknown: elsewhere\n[2024-01-30 00:00] unknown: word1\n[2024-01-29 00:00] unknown: word2" in story[1]
    assert set(story) == {1, 2} and 'from="bob"' in story[2]
    named = prompts.user_story_prompts(tables, AS_OF, 1, named_author=True).filter("user_id = 1").first()
    assert "ann: word1" in named.prompt
    digest = prompts.digest_prompts(tables, AS_OF, 1).first().prompt
    assert '"total_messages" : 3' in digest and "ann: word1" in digest and "{messages}" not in digest
    answered = prompts.apply_model(prompts.digest_prompts(tables, AS_OF), lambda p: f" {len(p)} ")
    assert all(r.answer == str(len(r.prompt)) for r in answered.collect())


def test_reports(spark, tmp_path):
    messages = [post(1, channel="the-discussion", text="https://bit.ly/a"), post(2, user=2)]
    tables = build(spark, messages, members=[(1, 1, AS_OF, None, True)])
    report = weekly_report.weekly_report(tables, AS_OF)
    weekly_report.save_report(report, str(tmp_path / "weekly"))
    lines = [r.line for r in weekly_report.report_lines(report).collect()]
    parts = sorted((tmp_path / "weekly").glob("part-*"))
    assert "".join(p.read_text() for p in parts).splitlines() == lines
    assert lines[:6] == ["# Weekly community statistics — 2024-01-31 (last 7 days)", "", "---", "", "", "## Home"]
    assert lines[lines.index("## Idle") + 2] == "_No activity this period._"
    assert "| Messages | 2 |" in lines and "- **ann** — 1 messages" in lines
    assert lines.count("_None found._") == 2
    assert "| 2024-01-30 | Home | #the-discussion | ann | https://bit.ly/a |" in lines

    full = analysis_report.analysis_report(tables, AS_OF, 1, lambda prompt: "ANSWER")
    text = "\n".join(r.line for r in weekly_report.report_lines(full).collect())
    assert text.startswith("# Home — Full Analysis\n_Generated 2024-01-31 00:00 · last 30 days_\n\n---\n")
    assert "## Weekly Digest\n\nANSWER" in text and "## Channel FAQ — #discussion\n\nANSWER" in text
    assert "### ann (1 messages)\n\nANSWER" in text and "| 2024-01-01 | 1 | 0 | +1 |" in text
    quiet = analysis_report.analysis_report(build(spark), AS_OF, 2, lambda prompt: "ANSWER")
    text = "\n".join(r.line for r in weekly_report.report_lines(quiet).collect())
    assert "_No activity in this period._" in text and "_Channel not found._" in text
    assert "_No membership data available._" in text and "ANSWER" not in text
