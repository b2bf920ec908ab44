"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte, its last byte marked as a word end.  A
heap holds the adjacent pairs that have a merge rank; the lowest rank (the
leftmost of equals) is popped, its two symbols become one in a doubly linked
list, and the new neighbours' pairs are pushed.  The count is the initial
symbols minus the merges: no identifiers are produced.  A word of n bytes costs
O(n log n), so one endless "word" is no worse than many short ones.

The merge table (a vocabulary file, of fixed size whatever the corpus) is read
on the driver and broadcast.  Text stays in its partition: no shuffle.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from eventide.llm.common import ref

#: Fixed values of the vocabulary file: how it splits normalised text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: Remembered words per task, and the longest word (in characters) remembered.
CACHE_WORDS, CACHE_CHARS = 400_000, 64


class Merges:
    """Merge table of a ``tokenizers`` JSON file whose model is a byte-level BPE
    with a word-end suffix: a pair of symbols -> its rank; a rank -> the symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        numbers: dict[str, int] = {}

        def number(symbol: str) -> int:
            return numbers.setdefault(symbol, len(numbers))

        chars = byte_chars()
        self.inner = [number(c) for c in chars]
        self.last = [number(c + suffix) for c in chars]
        self.by_rank: list[tuple[int, int, int]] = []
        self.rank: dict[tuple[int, int], int] = {}
        for left, right in spec["model"]["merges"]:
            pair = number(left), number(right)
            self.rank[pair] = len(self.by_rank)
            self.by_rank.append((*pair, number(left + right)))
        self.specials = sorted(t["content"] for t in spec["added_tokens"])


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    bytes stand for themselves, the others for the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def merged_count(word: bytes, merges: Merges) -> int:
    """Symbols that are left of a word when no pair can be merged any more."""
    n = len(word)
    if n < 2:
        return n
    symbol = [merges.inner[b] for b in word]
    symbol[-1] = merges.last[word[-1]]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, by_rank = merges.rank, merges.by_rank
    heap = [(r, i) for i in range(n - 1) if (r := rank.get((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    left_over = n
    while heap:
        r, i = heapq.heappop(heap)
        a, b, ab = by_rank[r]
        j = after[i]
        if symbol[i] != a or j == n or symbol[j] != b:
            continue  # one of the two has been merged since
        symbol[i], symbol[j] = ab, -1
        k = after[i] = after[j]
        left_over -= 1
        if k < n:
            before[k] = i
            if (r := rank.get((ab, symbol[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank.get((symbol[h], ab))) is not None:
            heapq.heappush(heap, (r, h))
    return left_over


def normalised(text: str) -> str:
    """NFC, then lower case character by character (no final sigma)."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class Counter(dict):
    """Tokens of a word, remembered; ``tokens`` counts a whole text."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges
        self.words = regex.compile(WORD_PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.specials)) or r"(?!)")

    def __missing__(self, word: str) -> int:
        n = merged_count(word.encode(), self.merges)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def tokens(self, text: str) -> int:
        """Special strings in the text are one token each and split it."""
        parts = self.special.split(text) if "<|" in text else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(normalised(p)))) for p in parts)


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", n_tokens: str = "n_tokens",
                 n_bytes: str = "n_bytes") -> DataFrame:
    """Add the UTF-8 length and the token count of each row's whole text.

    Null texts count as empty (0 bytes, 0 tokens).  Rows are independent:
    repeated rows each get their count, an empty table gives an empty result.
    Columns called ``n_bytes`` / ``n_tokens`` are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(Merges(vocabulary))

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(shared.value)
        for texts in batches:
            yield pd.Series([counter.tokens(t) for t in texts], dtype="int64")

    filled = F.coalesce(ref(text), F.lit(""))
    return df.withColumns({n_bytes: F.octet_length(filled).cast("long"), n_tokens: count(filled)})
