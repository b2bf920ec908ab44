"""Quality rules as a short-circuit cascade.

A rule rejects a document by features of its whole text.  Features are computed
when a rule first asks for them and kept for the next, so a document costs what
the rules before its rejection cost.  ``measure`` times every rule and counts
its rejections on a hash sample of the table (in the tasks; a row per rule comes
back), and ``ordered`` sorts the rules by rejections per second.  The order
changes what a verdict costs, never the verdict: a document is kept if no rule
rejects it.  One pass, no shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from eventide.llm.common import ASCII_SPACE, fresh, ref

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Documents expected in the sample that orders the rules.
SAMPLE_ROWS = 2000


class Features:
    """Features of one text, each computed once and only when asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # bytes: ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, ASCII_SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def worded_lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(ASCII_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.worded_lines) - len(set(self.worded_lines))

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, ascii_uppercase.encode()))

    @cached_property
    def n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, ascii_lowercase.encode()))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_window_words(self.words)


def repeated_window_words(words: Sequence[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code, kinds = ids[:n], len(number)
    span = kinds  # codes are below span
    for k in range(1, size):
        if span * kinds >= 2**62:
            code = np.unique(code, return_inverse=True)[1]
            span = n
        code = code * kinds + ids[k:k + n]
        span *= kinds
    order = np.argsort(code, kind="stable")
    same = np.diff(code[order]) == 0
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[k:k + n] |= again
    return int(covered.sum())


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Features], bool]


def few_words(f: Features) -> bool:
    return f.n_words < 10


def repeated_windows(f: Features) -> bool:
    return 100 * f.n_repeat_words > 20 * f.n_words


def many_symbols(f: Features) -> bool:
    """More than three marks in ten words."""
    return 10 * f.n_symbols > 3 * f.n_words


def duplicate_lines(f: Features) -> bool:
    """More than half of the lines repeat an earlier one."""
    return 2 * f.n_dup_lines > len(f.worded_lines)


def shouting(f: Features) -> bool:
    """More A-Z than a-z."""
    return f.n_upper > f.n_lower


def odd_word_length(f: Features) -> bool:
    """Words of fewer than 2 or more than 20 characters on average."""
    return not 2 * f.n_words <= f.word_chars <= 20 * f.n_words


BASE_RULES = (Rule("few_words", few_words), Rule("repeated_windows", repeated_windows))
RULES = (*BASE_RULES, Rule("many_symbols", many_symbols), Rule("duplicate_lines", duplicate_lines),
         Rule("shouting", shouting), Rule("odd_word_length", odd_word_length))


def measure(df: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per rule: documents seen, documents rejected and seconds, on a random sample
    of about ``sample_rows`` rows spread over the whole table, however many of them are
    copies.  Each rule is timed on features of its own, as if it came first."""
    rows = df.select(F.coalesce(ref(text), F.lit("")).alias("text")).sample(min(1.0, sample_rows / max(1, df.count())), seed=17)

    def timed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rule in rules:
                began = time.perf_counter()
                rejected = sum(rule.rejects(Features(t)) for t in batch["text"])
                yield pd.DataFrame({"rule": [rule.name], "n": [len(batch)], "rejected": [rejected],
                                    "seconds": [time.perf_counter() - began]})

    told = rows.mapInPandas(timed, "rule string, n long, rejected long, seconds double")
    return told.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("n", "rejected", "seconds")])


def ordered(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on the sample, most first; equals keep
    their given order."""
    told = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in measure(df, rules, text, sample_rows).collect()}
    return sorted(rules, key=lambda rule: -told.get(rule.name, 0.0))


def accepted(f: Features, rules: Sequence[Rule]) -> bool:
    return not any(rule.rejects(f) for rule in rules)


def keep_good(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, columns unchanged.

    A null text has no words and is rejected like an empty one; repeated rows
    share a verdict and all stay or all go; an empty table stays empty.
    """
    cascade = ordered(df, rules, text, sample_rows)

    @F.pandas_udf(BooleanType())
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([accepted(Features(t), cascade) for t in texts], dtype=bool)

    return df.where(good(F.coalesce(ref(text), F.lit(""))))


FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def judged(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with the base features of the whole text, ``base_failed`` and
    ``kept`` (no rule rejects).  Columns of these names are replaced."""
    cascade, names = ordered(df, rules, text, sample_rows), [x.split()[0] for x in FEATURES.split(", ")]

    @F.pandas_udf(f"{FEATURES}, base_failed boolean, kept boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for f in map(Features, texts):
            kept = accepted(f, cascade)
            rows.append((*(getattr(f, n) for n in names), not accepted(f, BASE_RULES), kept))
        return pd.DataFrame(rows, columns=[*names, "base_failed", "kept"])

    told = fresh(df.columns, "judged")
    out = df.withColumn(told, judge(F.coalesce(ref(text), F.lit(""))))
    return out.withColumns({n: F.col(f"{told}.{n}") for n in (*names, "base_failed", "kept")}).drop(told)
