"""Event extraction expressions: bold titles, dates, noise and sports cues, keyword labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.functions.text import WHITESPACE, fold_case, once, strip

# Unicode-aware character classes both regex engines in use agree on.
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
SPACE = f"[{WHITESPACE}]"

# Patterns and lengths of the event extraction.
TITLE_PATTERN = r"\*\*(.+?)\*\*|__(.+?)__"
DATE_PATTERNS = (
    rf"(?iu)(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday),?{SPACE}+"
    rf"({WORD}+ {DIGIT}{{1,2}}(?:st|nd|rd|th)?,?{SPACE}+{DIGIT}{{4}})",
    rf"(?iu)({DIGIT}{{1,2}}(?:st|nd|rd|th)?,?{SPACE}+{WORD}+,?{SPACE}+{DIGIT}{{4}})",
    rf"({DIGIT}{{1,2}}\.{DIGIT}{{1,2}}\.{DIGIT}{{4}})",
    rf"({DIGIT}{{4}}-{DIGIT}{{2}}-{DIGIT}{{2}})",
    rf"(?iu)📍{SPACE}*(?:{WORD}+,?{SPACE}+)?"
    rf"({WORD}+ {DIGIT}{{1,2}}(?:st|nd|rd|th)?,?{SPACE}+{DIGIT}{{4}})",
)
NOISE_WORDS = (
    r"Agenda|Schedule|When\?|Where\?|What|Why\?|How\?|Note:|TBC|TBA|"
    r"Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|"
    r"Practicalities|Overview|binding|speakers?:|about the|in total of|"
    r"if you|we got|it is"
)
NOISE_LETTERS = rf"[A-Z{WHITESPACE}]{{2,}}:?{SPACE}*$"
# Time patterns by a text that each of them needs.
TIME_CUES = {":": rf"{DIGIT}{{1,2}}:{DIGIT}{{2}}", "at ": rf"at {DIGIT}{{1,2}}"}
CLOCK_CUES = ("⌚", "🕐", "🕑", "🕒", "🕓", "🕔", "🕕", "🕖", "🕗", "🕘", "🕙", "🕚", "🕛")
PLACE_CUES = ("📍", "kisahalli", "töölö", "hive", "helsinki", "address", "location")
DAY_CUES = (
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "tomorrow", "tmw",
)
# Cue words by a text or bytes that all of a line have: where those are missing, none of the words is searched.
# Those of letters beyond ASCII are searched only where there are any.
CUES_BY_PART = (("day", tuple(w for w in DAY_CUES if w.endswith("day"))),)
CLOCK_BYTES = bytearray("🕐".encode()[:3])  # of all clock faces; the watch has its own
REPLY_LINE = (
    r"(?iud)^(count me in|i('m| am) in|me too|i'll come|i will|yes|no|"
    r"sure|sounds good|cool|great|ok|okay|thanks|thank you|"
    rf"@|https?://discord\.com|\+{DIGIT}|\[|are there|is it|when do|"
    r"courts? free|here we|is there still|can you|hey!?$)"
)
PHONE_LINE = rf"(?d)^\+?{DIGIT}[{DIGIT}{WHITESPACE}\-]{{7,}}$"
LINE_BREAKS = ("\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")
MIN_TITLE_CHARS = 5
MIN_EVENT_CHARS = 10
MIN_SPORTS_CHARS = 15
MIN_SPORTS_TITLE_CHARS = 4
SPORTS_CATEGORY = "sports"
OTHER_CATEGORY = "other"

# Label rules; the first keyword found in the lower-case title wins.
KEYWORD_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("induction", (
        "piscine", "orientation", "onboarding", "induction", "evaluation", "exam", "pedago",
        "42", "bocal", "selection", "admission", "get_next_line", "libft", "ft_printf",
        "born2beroot", "push_swap",
    )),
    ("sports", (
        "volleyball", "volley", "football", "soccer", "basketball", "tennis", "running",
        "runner", "climbing", "swim", "yoga", "stretching", "mindfulness", "martial",
        "fighting", "badminton", "frisbee", "beach", "sport", "workout", "fitness", "gym",
        "hike", "hiking", "cycling", "padel",
    )),
    ("wellness", (
        "meditation", "mental health", "wellbeing", "well-being", "hetki", "mindfulness",
        "breathing", "relaxation", "stress", "burnout", "sleep", "nutrition", "health",
    )),
    ("gaming", (
        "game night", "game of the month", "magic the gathering", "mtg", "mafia", "werewolf",
        "werewolves", "board game", "tabletop", "dungeons", "d&d", "dnd", "rpg", "video game",
        "esport", "fighting game", "supercell", "minecraft",
    )),
    ("creative", (
        "3d print", "3d-print", "electronics", "soldering", "hardware", "music", "concert",
        "photography", "film", "kino", "cinema", "art", "drawing", "painting", "craft",
        "maker", "diy",
    )),
    ("tech", (
        "workshop", "hackathon", "sprint", "demo", "tech talk", "tech career", "ai",
        "machine learning", "ml", "llm", "python", "javascript", "rust", "golang", "fastapi",
        "api", "web", "cloud", "linux", "cybersecurity", "security", "devops", "kubernetes",
        "docker", "software", "developer", "engineer", "coding", "programming", "startup",
        "product", "ux", "ui", "design", "data science", "excursion", "company visit",
        "office tour", "visit to", "career", "job", "internship", "summer job", "recruitment",
        "cv", "resume", "interview", "linkedin", "portfolio",
    )),
    ("learning", (
        "book club", "language cafe", "kieli kahvila", "study", "lecture", "seminar", "talk",
        "presentation", "panel", "public speaking", "writing", "communication", "english",
        "finnish", "french", "spanish", "german",
    )),
    ("social", (
        "gala", "party", "brunch", "lunch", "dinner", "breakfast", "coffee", "drinks",
        "sitsit", "afterwork", "after work", "networking", "mixer", "social", "gathering",
        "meetup", "meet up", "hangout", "hang out", "picnic", "barbecue", "bbq", "market",
        "fair", "xmas", "christmas", "halloween", "easter", "pikkujoulu", "sauna", "karaoke",
        "trivia", "quiz", "beecoming", "volunteer", "alumni",
    )),
)


def long_enough(content: Column, chars: int) -> Column:
    return F.length(strip(content)) >= chars


def is_marked(content: Column) -> Column:
    """Whether the text has a title marker at all; a plain byte search."""
    return F.contains(content, F.lit("**")) | F.contains(content, F.lit("__"))


def titles(content: Column) -> Column:
    """Stripped bold or underlined spans in order, short ones and mentions left out."""
    spans = F.regexp_extract_all(content, F.lit("(?d)" + TITLE_PATTERN), F.lit(0))
    cut = F.transform(spans, lambda s: strip(F.substring(s, F.lit(3), F.length(s) - 4)))
    return F.filter(cut, lambda t: (F.length(t) >= MIN_TITLE_CHARS) & ~t.startswith("@"))


def has_year(content: Column) -> Column:
    """Four digits in a row, which every date pattern needs; one quick pass."""
    return content.rlike(rf"{DIGIT}{{4}}")


def has_date(content: Column) -> Column:
    return has_year(content) & content.rlike("|".join(f"(?:{p})" for p in DATE_PATTERNS))


def event_date(content: Column) -> Column:
    """First date of the first pattern that matches anywhere, or ''."""
    found = [F.nullif(F.regexp_extract(content, p, 1), F.lit("")) for p in DATE_PATTERNS]
    bare = F.btrim(strip(F.coalesce(*found, F.lit(""))), F.lit(","))
    return F.when(has_year(content), bare).otherwise(F.lit(""))


def is_noise(title: Column, strict_case: bool = False) -> Column:
    """Section headers, and any title of only ASCII letters and spaces.

    The letters rule ignores case, so it also drops titles such as "Book club:".
    ``strict_case`` limits it to capitals.
    """
    if strict_case:
        return title.rlike(f"(?iud)^(?:{NOISE_WORDS})") | title.rlike(f"(?d)^{NOISE_LETTERS}")
    return title.rlike(f"(?iud)^(?:{NOISE_WORDS}|{NOISE_LETTERS})")


def first_line(content: Column) -> Column:
    line = strip(content)
    for line_break in LINE_BREAKS:
        line = F.substring_index(line, line_break, 1)
    return strip(line)


def has_cue(content: Column) -> Column:
    """A time, a place, a weekday or a date.

    Byte searches over one folded copy decide for nearly all text: they take less time than a
    single alternation of all cues, which stops at every other letter. One search stands for the words that
    share a part, and words of other letters than ASCII are searched in texts that have such.
    Patterns run behind the byte that they need.
    """
    times = reduce(
        Column.__or__,
        [F.contains(content, F.lit(needed)) & content.rlike(cue) for needed, cue in TIME_CUES.items()],
    )
    return times | once(fold_case(content), _has_cue_word) | has_date(content)


def _has_cue_word(text: Column) -> Column:
    """Whether folded text has a word or sign of a place, day or clock."""

    def any_of(words: Sequence[str]) -> Column:
        return reduce(Column.__or__, [F.contains(text, F.lit(word)) for word in words])

    shared = {word for _, words in CUES_BY_PART for word in words}
    clocks = [cue for cue in CLOCK_CUES if cue.encode()[:3] == bytes(CLOCK_BYTES)]
    alone = [w for w in (*PLACE_CUES, *DAY_CUES, *CLOCK_CUES) if w not in shared and w not in clocks]
    found = any_of([w for w in alone if w.isascii()])
    for part, words in CUES_BY_PART:
        found = found | (F.contains(text, F.lit(part)) & any_of(words))
    beyond_ascii = F.octet_length(text) > F.char_length(text)
    clock = F.contains(text.cast("binary"), F.lit(CLOCK_BYTES)) & any_of(clocks)
    return found | (beyond_ascii & (any_of([w for w in alone if not w.isascii()]) | clock))


def is_sports_post(content: Column) -> Column:
    """An organising post: long enough, no mere reply, with a time, place or date cue.

    The checks on the first line, which is short, come first.
    """

    def fits(line: Column) -> Column:
        reply = line.rlike(REPLY_LINE) | line.rlike(PHONE_LINE)
        return (F.length(line) >= MIN_SPORTS_TITLE_CHARS) & ~reply

    def qualifies(text: Column) -> Column:
        return long_enough(text, MIN_SPORTS_CHARS) & once(first_line(text), fits) & has_cue(text)

    return once(content, qualifies)


def raw_text(content: Column, chars: int | None = None) -> Column:
    """The whole text, or its first characters where the caller wants an excerpt."""
    return content if chars is None else F.substring(content, 1, chars)


def keyword_label(
    title: Column, rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES
) -> Column:
    """``struct(category, keyword)`` of the first keyword contained in the lower-case title,
    or ("other", "")."""
    category_of = {}
    for category, keywords in rules:
        for keyword in keywords:
            category_of.setdefault(keyword, category)
    lower = F.lower(title)
    hits = F.filter(F.lit(list(category_of)), lambda keyword: F.contains(lower, keyword))
    keyword = F.coalesce(F.get(hits, F.lit(0)), F.lit(""))
    categories = F.create_map(*[F.lit(x) for pair in category_of.items() for x in pair])
    return F.struct(
        F.coalesce(F.try_element_at(categories, keyword), F.lit(OTHER_CATEGORY)).alias("category"),
        keyword.alias("keyword"),
    )
