"""Text expressions: whitespace, token estimate, LIKE patterns, line format, templates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace set, the token estimate and the line format.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE = r"\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKENS_PER_WORD = 1.3
DEFAULT_MAX_TOKENS = 8000
LINE_TIME_FORMAT = "yyyy-MM-dd HH:mm"
UNKNOWN_AUTHOR = "unknown"


# The same set as a class of Java patterns, where it is much quicker than the listed ranges.
_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Cut Unicode whitespace on both sides (``trim`` knows only the plain space)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def estimate_tokens(text: Column) -> Column:
    """0 for NULL or empty text, else words times 1.3 rounded down, at least 1."""
    # Almost all text has no whitespace but spaces and newlines; there a plain split does.
    odd = text.rlike(rf"(?U)[{_SPACE}&&[^ \n]]")
    plain = F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")
    gaps = F.regexp_count(strip(text), F.lit(rf"(?U){_SPACE}+"))
    words = F.when(odd, gaps + 1).otherwise(F.greatest(F.lit(1), F.size(plain)))
    tokens = F.floor(words * F.lit(TOKENS_PER_WORD)).cast("long")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0).cast("long")).otherwise(tokens)


# The whitespace beyond ASCII: its codes by their width in bytes, and the bytes they begin with.
_WIDE_SPACES: dict[int, list[int]] = {}
for _code in (c.encode() for c in WHITESPACE_CHARS if not c.isascii()):
    _WIDE_SPACES.setdefault(len(_code), []).append(int.from_bytes(_code, "big"))
_WIDE_LEADS = sorted({code >> 8 * (width - 1) for width, codes in _WIDE_SPACES.items() for code in codes})
# Bytes whose words are counted at a time: arrays as small as that are not given back to the system each time.
_COUNT_BYTES = 1 << 17


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text are whitespace or part of one."""
    # \t to \r and \x1c to the space; what lies below wraps round to large numbers.
    space = ((data - np.uint8(9)) <= np.uint8(4)) | ((data - np.uint8(28)) <= np.uint8(4))
    leads = np.flatnonzero(reduce(np.bitwise_or, [data == np.uint8(lead) for lead in _WIDE_LEADS]))
    for width, codes in _WIDE_SPACES.items() if len(leads) else ():
        leads = leads[leads + width <= len(data)]
        code = np.zeros(len(leads), np.int64)
        for i in range(width):
            code = code << 8 | data[leads + i]
        found = leads[np.isin(code, codes)]
        for i in range(width):
            space[found + i] = True
    return space


def token_counts(texts: pa.Array, lead: np.ndarray | int = 0, filled: np.ndarray | None = None) -> np.ndarray:
    """What ``estimate_tokens`` gives for texts that are in a Python worker anyway, at a tenth of its time.

    The first ``lead`` bytes of a text are no part of it and end in whitespace; ``filled`` says which texts are not
    empty, where what is left of them does not.
    """
    rows = len(texts)
    if rows == 0:
        return np.zeros(0, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    begins, words, low = np.minimum(ends[:-1] + lead, ends[1:]), np.zeros(rows, np.int64), 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + _COUNT_BYTES, "right")) - 1)
        base, edge = ends[low], ends[high]
        space = _spaces(data[base:edge])
        begun = ~space
        begun[1:] &= space[:-1]
        first = begins[low:high][begins[low:high] < ends[low + 1 : high + 1]] - base
        begun[first] = ~space[first]
        at = np.flatnonzero(begun) + base
        words[low:high] = np.searchsorted(at, ends[low + 1 : high + 1]) - np.searchsorted(at, begins[low:high])
        low = high
    tokens = np.floor(np.maximum(words, 1) * TOKENS_PER_WORD).astype(np.int64)
    return np.where(ends[1:] > ends[:-1] if filled is None else filled, tokens, 0)


def fold_case(text: Column) -> Column:
    """Lower case, with the few other letters that match an ASCII letter when case is ignored."""
    folded, odd = text, F.lit(False)
    for letter, plain in (("ſ", "s"), ("\u212a", "k"), ("ı", "i"), ("İ", "i")):
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
        odd = odd | F.contains(text, F.lit(letter))
    return F.lower(F.when(odd, folded).otherwise(text))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time per row, wherever it is placed."""
    return F.transform(F.array(value), use)[0]


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Whether prepared text contains any of the words."""
    return once(
        text,
        lambda prepared: reduce(
            Column.__or__, [F.contains(prepared, F.lit(word)) for word in words]
        ),
    )


def like_pattern(term: str) -> str:
    """``%term%`` with the term's own wildcards kept.

    A backslash before an ordinary character stands for that character; Spark rejects such
    a pair, so it is resolved here.
    """
    pattern, out, i = f"%{term}%", [], 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            following = pattern[i + 1]
            out.append("\\" + following if following in "%_\\" else following)
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return "".join(out)


def contains_ilike(column: Column, term: str) -> Column:
    return column.ilike(like_pattern(term))


def line_lead(created_at: Column | None = None, author: Column | None = None) -> Column:
    """What stands before the content in a line: ``[2024-01-15 14:32] author: ``."""
    name = F.lit(UNKNOWN_AUTHOR)
    if author is not None:
        name = F.coalesce(F.nullif(author, F.lit("")), name)
    lead = F.concat(name, F.lit(": "))
    if created_at is not None:
        stamp = F.concat(F.lit("["), F.date_format(created_at, LINE_TIME_FORMAT), F.lit("] "))
        lead = F.concat(F.coalesce(stamp, F.lit("")), lead)
    return lead


def format_line(
    content: Column, created_at: Column | None = None, author: Column | None = None
) -> Column:
    """``[2024-01-15 14:32] author: content``; NULL where the content is blank.

    Without a time (argument or value) the bracket is left out; an empty or missing author
    prints as "unknown".
    """
    body = strip(F.coalesce(content, F.lit("")))
    return F.when(body != "", F.concat(line_lead(created_at, author), body))


def fill_template(template: str | Column, values: Mapping[str, Column]) -> Column:
    """Replace ``{key}`` by its value, key after key, so a later key also hits inserted text."""
    filled = F.lit(template) if isinstance(template, str) else template
    for key, value in values.items():
        filled = F.replace(filled, F.lit("{" + key + "}"), value.cast("string"))
    return filled


def sorted_distinct(column: Column) -> Column:
    """Distinct values in ascending order with NULL kept as the last element."""
    pairs = F.array_sort(F.collect_set(F.struct(column.isNull().alias("n"), column.alias("v"))))
    return F.transform(pairs, lambda pair: pair["v"])
