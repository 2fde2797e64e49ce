"""Token counts by a map-side lookup in two tiers; no pre-token is ever shuffled.

A byte-level BPE never merges across pre-tokens, so the tokens of a text are the sum over its
pre-tokens. The first tier is a broadcast table of the lengths of frequent pre-tokens, at most
``TABLE_ENTRIES`` of them, each of at most ``PIECE_BYTES`` bytes: about 10 MB whatever the corpus. The
second is a cache that every Python worker keeps: it holds the lengths of the misses it has encoded,
is emptied when it is full, and never leaves the worker. One narrow map over the documents does
everything; the only rows that move are the sampled documents the table is made from.

The table changes the time, not the result: any table, an empty one as well, gives the same counts.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import buffer, kept_by_worker, texts

LIMIT = 1024
#: Entries of the broadcast table, and the longest pre-token it takes.
TABLE_ENTRIES = 65_536
PIECE_BYTES = 64
#: Documents, and characters of each, that the table is made from. It decides nothing but speed.
SAMPLE_DOCS = 4_000
SAMPLE_CHARS = 16_384
#: Pre-tokens a worker remembers beyond the table, by count and by their characters in all.
CACHE_ENTRIES = 400_000
CACHE_CHARS = 16_000_000
#: Characters after which a long text is cut, at the next boundary no pre-token crosses.
STRETCH = 1 << 20

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# The pre-token pattern of byte-level BPE, with its classes written out for the characters below
# U+0250, whose letters and numbers no Unicode version changes. Other texts take the library's own split.
_SPACE = "\\t-\\r \\x85\\xa0"
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_PIECES = (
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_PLAIN = re.compile(_PIECES)
# Also plain: marks that are neither letter, number nor space (dashes, quotes, bullets, the euro sign).
_OTHER = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A text in parts of at least ``size`` characters, cut before a single space between two letters.

    Such a space always opens a pre-token, so the parts hold the pre-tokens of the text.
    """
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Lengths:
    """Tokens of texts by the two tiers. ``table`` is shared and never changed."""

    def __init__(self, path: str, table: dict[str, int]) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = sorted(
            (t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True
        )
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.table = table
        self.known = dict(table)
        self.chars = 0

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if _OTHER.search(text) is None:
            return _PLAIN.findall(text)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[begin:end] for _, (begin, end) in found]

    def count(self, text: str) -> int:
        total = 0
        parts = [text]
        if any(mark in text for mark in self.specials):
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            for stretch in stretches(part):
                total += self._sum(self.pieces(stretch))
        return total

    def _sum(self, pieces: list[str]) -> int:
        found = list(map(self.known.get, pieces))
        if None not in found:
            return sum(found)
        fresh = {piece for piece, length in zip(pieces, found, strict=True) if length is None}
        total = sum(length for length in found if length is not None)
        lengths = self._encode(list(fresh))
        total += sum(lengths[piece] for piece, length in zip(pieces, found, strict=True) if length is None)
        size = sum(map(len, fresh))
        if len(self.known) + len(fresh) > len(self.table) + CACHE_ENTRIES or self.chars + size > CACHE_CHARS:
            self.known = dict(self.table)
            self.chars = 0
        if len(fresh) <= CACHE_ENTRIES and size <= CACHE_CHARS:
            self.known.update(lengths)
            self.chars += size
        return total

    def _encode(self, fresh: list[str]) -> dict[str, int]:
        """A pre-token alone splits into itself, so its tokens are those of a text of its own."""
        coded = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        return {piece: len(one.ids) for piece, one in zip(fresh, coded, strict=True)}


def frequent_lengths(docs: DataFrame, path: str, entries: int = TABLE_ENTRIES, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of a bounded sample of documents.

    Documents are chosen by their hash; they, no pre-tokens, move to one task, which returns at
    most ``entries`` rows. Rows, characters and entries are bounded at every corpus size.
    """
    total = docs.count()
    if not total or not entries:
        return {}
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(max(1, total // sample_docs))) == 0)
    sample = chosen.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(sample_docs).repartition(1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path, {})
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                seen.update(lengths.pieces(text))
        short = [(n, piece) for piece, n in seen.items() if len(piece.encode()) <= PIECE_BYTES]
        short.sort(key=lambda item: (-item[0], item[1]))
        coded = lengths._encode([piece for _, piece in short[:entries]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(coded), pa.string()), pa.array(list(coded.values()), pa.int32())], names=["piece", "length"]
        )

    found = sample.mapInArrow(count, "piece string, length int").toArrow()
    return dict(zip(found["piece"].to_pylist(), found["length"].to_pylist(), strict=True))


def count_tokens(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, table: dict[str, int] | None = None
) -> DataFrame:
    """Bytes and tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit).

    Counts are those of the tokenizer file at ``path`` without begin, end or padding; a special
    string inside a text is one token, as the library has it. A null text counts as empty: 0 bytes,
    0 tokens. Null ids and repeated rows give one row each. A very long text is counted in
    stretches, so only its own length is held. An empty table gives an empty one; further columns are
    left out, whatever their names. ``table`` replaces the table of frequent pre-tokens.
    """
    path = path or tokenizer_path()
    rows = texts(docs)
    if table is None:
        table = frequent_lengths(rows, path)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    key = uuid.uuid4().hex  # workers outlive a job, so a table is known by its own name

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = kept_by_worker("token lengths", key, lambda: Lengths(path, shared.value))
        for batch in batches:
            _, at = buffer(batch["text"])
            tokens = [
                lengths.count(text)
                for low in range(0, len(batch), 64)
                for text in batch["text"].slice(low, 64).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(at[1:] - at[:-1], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(count, COUNTS)
