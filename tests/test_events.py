"""Titles, dates, sports posts, labels and de-duplication on hand-written rows."""

import re
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palaver.functions import events as ev
from palaver.functions.text import WHITESPACE_CHARS, mentions
from palaver.operators import events
from palaver.plans import event_catalogue
from palaver.sources import catalogue
from palaver.sources.tables import Tables

START = datetime(2024, 1, 1)


def column(spark, texts, expression):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in frame.select("i", expression(F.col("t"))).orderBy("i").collect()]


def test_titles(spark):
    texts = [
        "**x** is short", "__Under line__ and **Bold one**", "**@all hands** hello", "**across\nlines**",
        "** padded  ** text", "no markers here", "**short", "**Día de salsa** 🎉", "**12345**",
        "**a*b*c**d** x",
    ]
    assert column(spark, texts, ev.titles) == [
        [], ["Under line", "Bold one"], [], [], ["padded"], [], [], ["Día de salsa"], ["12345"],
        ["a*b*c"],
    ]


pieces = st.sampled_from(["**", "__", "*", "_", "@", " ", "\n", "word", "Title 1", "é", " "])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=200, max_size=200))
def test_titles_like_python(spark, texts):
    def expected(text):
        found = (m.group()[2:-2].strip() for m in re.finditer(ev.TITLE_PATTERN, text))
        return [t for t in found if len(t) > 4 and t[0] != "@"]

    assert column(spark, texts, ev.titles) == [expected(t) for t in texts]


def test_dates(spark):
    samples = {
        "Wednesday, February 11, 2026 at 15:00": "February 11, 2026",
        "on the 18th March 2026": "18th March 2026",
        "18th, March, 2026": "18th, March, 2026",
        "am 25.2.2026 um 13.00": "25.2.2026",
        "2026-02-11": "2026-02-11",
        "13.00": "",
        "25.2 at 17:00": "",
        "2025-06-10 or FRIDAY May 1 2026": "May 1 2026",
        "📍 Mittwoch, Helmikuu 18, 2026": "Helmikuu 18, 2026",
        "friday März 3rd, 2026": "März 3rd, 2026",
        "year 2026 only": "",
        "": "",
    }
    assert column(spark, list(samples), ev.event_date) == list(samples.values())


def test_noise(spark):
    texts = ["Agenda for today", "Demo Thursday", "Book club:", "Weekly 5k run", "WHEN?", "Speaker: A1", "Ünïcode", "note: 1"]
    assert column(spark, texts, ev.is_noise) == [True, True, True, False, True, True, False, True]
    strict = column(spark, texts, lambda t: ev.is_noise(t, strict_case=True))
    assert strict == [True, False, False, False, True, True, False, True]


def test_sports_posts(spark):
    texts = {
        "🏐Friday Volleyball\n⌚️18:30\n📍Töölö": True,
        "Count me in for friday please": False,
        "+358 40 123 4567\nfriday at 18": False,
        "no cue in this long sentence": False,
        "training in HELSINKI for all": True,
        "courts free on friday? anyone": False,
        "run\nfriday at 18:00 from the park": False,
        "short 18:00": False,
        "We play tomorrow, join us now": True,
        "hey! tomorrow we go running": True,
        "meet in the loſt-and-found locatıon": True,
    }
    assert column(spark, list(texts), ev.is_sports_post) == list(texts.values())
    lines = ["  first \r\nsecond", "a\x0bb", "one two", "\n\n x \n y", "z"]
    assert column(spark, lines, ev.first_line) == [t.strip().splitlines()[0].strip() for t in lines]


def test_case_folding_like_python(spark):
    texts = [f"a{chr(c)}z" for c in range(0x80, 0x2200)] + ["KİTCHEN", "ſauna", "Kino"]
    words = ["k", "s", "i"]
    got = column(spark, texts, lambda t: mentions(ev.fold_case(t), words))
    pattern = re.compile("|".join(words), re.IGNORECASE)
    assert got == [bool(pattern.search(t)) for t in texts]


def test_keywords(spark):
    titles = ["Volleyball party", "Training day", "PARTY time", "Piscine 42", "Nothing", "", "Xmas fair"]
    got = column(spark, titles, ev.keyword_label)

    def expected(title):
        for category, keywords in ev.KEYWORD_RULES:
            for keyword in keywords:
                if keyword in title.lower():
                    return category, keyword
        return "other", ""

    assert [tuple(r) for r in got] == [expected(t) for t in titles]
    assert sum(len(keywords) for _, keywords in ev.KEYWORD_RULES) == 192


def make_tables(spark, contents):
    """``contents``: (channel, text) in time order."""
    rows = [
        (i, 1, 1, channel, 7, text, START + timedelta(minutes=i), False)
        for i, (channel, text) in enumerate(contents)
    ]
    messages = spark.createDataFrame(
        rows,
        "message_id long, server_id long, channel_id long, channel_name string, user_id long, "
        "content string, created_at timestamp_ntz, is_deleted boolean",
    )
    users = spark.createDataFrame([(7, 7, "ann")], "user_id long, discord_id long, current_username string")
    return Tables(lambda name: {"messages": messages, "users": users}[name])


def test_catalogue(spark):
    tables = make_tables(
        spark,
        [
            ("sport", "Run 5k club\nfriday 18:00 at the park"),
            ("news", "**Gala 2026** on 2026-02-11"),
            ("late news", "**GALA 2026 ** on 2026-03-11"),
            ("sport", "gala 2026\nfriday 18:00 at the park"),
            ("news", "**Agenda 1** is noise but **Hack 24h** is not"),
            ("other", "**Never read 1** 2026-01-01"),
        ],
    )
    channels = events.ChannelSet(event=("late news", "news"), sports=("sport",))
    found = event_catalogue.raw_catalogue(tables, 1, channels)
    got = {(r.title, r.date, r.category, r.source_channel) for r in found.collect()}
    # Channel order decides before time: the later post of the first channel wins.
    assert got == {
        ("GALA 2026", "2026-03-11", None, "late news"), ("Hack 24h", "", None, "news"),
        ("Run 5k club", "", "sports", "sport"),
    }
    alone = event_catalogue.label_with_model(found)
    assert {(r.title, r.category) for r in alone.collect()} == {
        ("GALA 2026", "other"), ("Hack 24h", "other"), ("Run 5k club", "sports"),
    }
    answer = '```json\n[{"category": "tech"}, 5, {"category": "late"}]\n```'
    asked = event_catalogue.label_with_model(found, lambda prompt: answer)
    assert {(r.title, r.category) for r in asked.collect()} == {
        ("GALA 2026", "tech"), ("Hack 24h", "other"), ("Run 5k club", "sports"),
    }

    def fails(prompt):
        raise RuntimeError("no answer")

    failed = event_catalogue.label_with_model(found, fails)
    assert {r.category for r in failed.collect()} == {"other", "sports"}


def test_row_limits_on_a_hot_channel(spark):
    limits = {"event": 50, "sports": 20}
    tables = make_tables(spark, [(("hot", "cold", "sport")[0 if i % 3 else i % 2 + 1], f"text {i}") for i in range(600)])
    channels = events.ChannelSet(event=("hot", "cold"), sports=("sport",))
    kept = [
        row
        for kind in ("event", "sports")
        for row in events.channel_set_messages(tables, None, channels, kind, limits[kind]).collect()
    ]
    for channel, limit in (("hot", 50), ("cold", 50), ("sport", 20)):
        oldest = sorted(r.message_id for r in tables.messages.filter(F.col("channel_name") == channel).collect())
        assert sorted(r.message_id for r in kept if r.channel_name == channel) == oldest[:limit]


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ('say "hi", all', "2026-02-11", "social", "", "news", "two\nlines, and \"quotes\""),
        ("plain", None, "other", "", "news", "x"),
        ("back\\slash", "2025-01-01", "tech", "tech", "news", "comma, here"),
    ]
    frame = spark.createDataFrame(
        rows, "title string, date string, category string, matched_keyword string, "
        "source_channel string, raw_text string",
    )
    path = str(tmp_path / "events")
    catalogue.write_events_csv(frame, path)
    back = catalogue.read_events_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(
        (t, d or "", c, s, raw) for t, d, c, _, s, raw in rows
    )
    assert [r.title for r in catalogue.event_rows(frame).collect()] == ["plain", "back\\slash", 'say "hi", all']
    labelled = str(tmp_path / "labelled")
    catalogue.write_labelled_csv(events.keyword_category(frame), labelled)
    assert spark.read.option("header", True).csv(labelled).columns[3] == "matched_keyword"


def test_coverage_without_events(spark):
    empty = spark.createDataFrame([], "title string, category string")
    assert tuple(events.label_coverage(empty).first()) == (0, 0, 0, None)


def test_whitespace_set():
    assert set(WHITESPACE_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_weekly_csv_is_newest_first(spark, tmp_path):
    weeks = [(START.date() + timedelta(weeks=i), i, 10 * i) for i in range(3)]
    frame = spark.createDataFrame(weeks, "week_start date, active_users long, total_messages long")
    path = str(tmp_path / "weekly")
    catalogue.write_weekly_csv(frame, path)
    lines = [line for part in sorted((tmp_path / "weekly").glob("part-*")) for line in part.read_text().splitlines()]
    assert [line for line in lines if "week_start" not in line] == [
        '"2024-01-15","2","20"', '"2024-01-08","1","10"', '"2024-01-01","0","0"',
    ]
    assert lines[0] == '"week_start","active_users","total_messages"'
