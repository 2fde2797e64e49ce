"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a pair of columns: a measure and a test that rejects. A sample gives each rule's
cost (seconds to compute its measure over the sample) and selectivity (share of rows it
rejects); rules run in the order of rejections per cost, and a row leaves at its first
rejection. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5
SAMPLE_ROWS = 500


def words(text: Column) -> Column:
    """The words of a text in order, as an array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return _bound(lines, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; a lambda would compute a plain column at every step."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(parts: Column) -> Column:
    """A hash for each window: of words, then of pairs, of four, of five, by shifted arrays."""

    def joined(left: Column, right: Column, shift: int) -> Column:
        shifted = F.slice(right, shift + 1, F.size(right))
        return F.zip_with(left, shifted, lambda a, b: F.xxhash64(a, b))

    def five(single: Column) -> Column:
        four = _bound(joined(single, single, 1), lambda pair: joined(pair, pair, 2))
        # The shifted arrays end early; the hashes of incomplete windows are cut off.
        return F.slice(joined(four, single, WINDOW - 1), 1, F.greatest(F.lit(0), F.size(single) - F.lit(WINDOW - 1)))

    return _bound(F.transform(parts, lambda word: F.xxhash64(word)), five)


_PLACE = 24  # bits for the place of a window beside 40 bits of its hash


def n_repeat_words(parts: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the same text.

    Most texts repeat no window, which the distinct hashes of the windows prove. Otherwise hashes
    and places are sorted side by side as numbers and equal neighbours are compared word by
    word; if two different windows share a hash there, or places do not fit, the windows
    themselves are sorted instead.
    """
    none = F.lit(0).cast("long")

    def count(parts: Column) -> Column:
        def sorted_out(hashes: Column) -> Column:
            packed = F.transform(hashes, lambda h, i: F.shiftleft(h, _PLACE).bitwiseOR(i.cast("long")))
            repeated = F.size(hashes) > F.size(F.array_distinct(hashes))
            starts = _bound(F.sort_array(packed), lambda rows: _starts_by_hash(parts, rows))
            return F.when(repeated, _covered(starts)).otherwise(none)

        return F.when(F.size(parts) <= WINDOW, none).otherwise(_bound(_window_hashes(parts), sorted_out))

    return _bound(parts, count)


def _starts_by_hash(parts: Column, rows: Column) -> Column:
    """Sorted starts of repeated windows, from sorted (hash, place) numbers."""

    def place(row: Column) -> Column:
        return row.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")

    def same(row: Column, other: Column) -> Column:
        return F.coalesce(F.shiftrightunsigned(row.bitwiseXOR(other), _PLACE) == 0, F.lit(False))

    def window(row: Column) -> Column:
        return F.slice(parts, place(row) + 1, WINDOW)

    clash = F.exists(
        F.filter(rows, lambda row, i: same(row, F.get(rows, i - 1)) & (window(row) != window(F.get(rows, i - 1)))), lambda row: F.lit(True)
    )
    quick = F.transform(
        F.filter(rows, lambda row, i: same(row, F.get(rows, i - 1)) | same(row, F.get(rows, i + 1))), place
    )
    too_long = F.size(rows) >= 1 << _PLACE
    return F.sort_array(F.when(too_long | clash, _starts_by_words(parts)).otherwise(quick))


def _starts_by_words(parts: Column) -> Column:
    """Starts of the windows that equal another window, by sorting the windows."""
    spelled = F.transform(F.sequence(F.lit(1), F.size(parts) - F.lit(WINDOW - 1)), lambda i: F.concat_ws(" ", F.slice(parts, i, WINDOW)))
    ordered = F.array_sort(F.transform(spelled, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))

    def pick(ordered: Column) -> Column:
        def again(row: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["window"], F.get(ordered, i + 1)["window"]
            return F.coalesce(row["window"] == before, F.lit(False)) | F.coalesce(row["window"] == after, F.lit(False))

        return F.transform(F.filter(ordered, again), lambda row: row["at"])

    return _bound(ordered, pick)


def _covered(starts: Column) -> Column:
    """Words under the windows that begin at the sorted ``starts``."""

    def gaps(starts: Column) -> Column:
        after = F.slice(starts, 2, F.size(starts))
        own = F.zip_with(starts, after, lambda at, then: F.least(F.lit(WINDOW), F.coalesce(then - at, F.lit(WINDOW))).cast("long"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, words: total + words)

    return _bound(starts, gaps)


class Measures:
    """What the rules look at, computed from the text where a rule asks for it."""

    def __init__(self, text: Column) -> None:
        self.text = text

    def n_words(self) -> Column:
        return F.size(words(self.text)).cast("long")

    def word_chars(self) -> Column:
        return F.length(F.array_join(words(self.text), "")).cast("long")

    def n_symbols(self) -> Column:
        return n_symbols(self.text)

    def n_lines(self) -> Column:
        return F.size(F.split(self.text, "\n")).cast("long")

    def n_dup_lines(self) -> Column:
        return n_dup_lines(self.text)

    def n_repeat_words(self) -> Column:
        return n_repeat_words(words(self.text))


class Computed(Measures):
    """The same from columns that hold them."""

    def __getattribute__(self, name: str):
        return lambda: F.col(name)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], Column]


#: Fixed thresholds. The first two rules are the base; a text may fail any.
RULES = (
    Rule("few_words", lambda m: m.n_words() < 10),
    Rule("repeated_windows", lambda m: m.n_repeat_words() * 100 > m.n_words() * 20),
    Rule("symbols", lambda m: m.n_symbols() * 10 > m.n_words()),
    Rule("duplicate_lines", lambda m: m.n_dup_lines() * 2 > m.n_lines()),
    Rule("long_words", lambda m: m.word_chars() > m.n_words() * 20),
)
BASE = ("few_words", "repeated_windows")


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on ``sample_rows`` rows, best rejection per cost first.

    The sample only sets the order; all rules see all rows later.
    """
    sample = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).limit(sample_rows).cache()
    try:
        rows = max(1, sample.count())
        found = []
        for rule in rules:
            began = time.perf_counter()
            rejected = sample.filter(rule.rejects(Measures(F.col("text")))).count()
            found.append((rule, time.perf_counter() - began, rejected / rows))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda item: (-item[2] / item[1], item[0].name))


def cascade(measures: Measures, rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """True where no rule rejects; CASE stops at the first that does."""
    verdict = F.when(rules[0].rejects(measures), F.lit(False))
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects(measures), F.lit(False))
    return verdict.otherwise(F.lit(True))


def figures(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document with the five base figures, base_failed and kept.

    Null text counts as no words. Any doc_id is passed through, null and repeated ones too.
    """
    order = [rule for rule, _, _ in measure(docs, rules)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lazy = Measures(F.col("text"))
    base = [rule for rule in order if rule.name in BASE]
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .withColumn("parts", words(F.col("text")))
        .select(
            "doc_id",
            F.size("parts").cast("long").alias("n_words"),
            F.length(F.array_join("parts", "")).cast("long").alias("word_chars"),
            lazy.n_symbols().alias("n_symbols"),
            lazy.n_dup_lines().alias("n_dup_lines"),
            n_repeat_words(F.col("parts")).alias("n_repeat_words"),
            lazy.n_lines().alias("n_lines"),
        )
        .withColumn("base_failed", ~cascade(Computed(text), base))
        .withColumn("kept", cascade(Computed(text), order))
        .drop("n_lines")
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = [rule for rule, _, _ in measure(docs, rules)]
    return docs.filter(cascade(Measures(F.coalesce(F.col("text").cast("string"), F.lit(""))), order))
