"""Licence scan with a positional index of rare words.

A template is a notice with a mandatory key phrase.  The words of all key phrases are the
licence vocabulary; their document frequencies over the whole corpus give their IDF (one
row per vocabulary word reaches the driver).  The index maps a word to postings: the
templates whose key phrase has it, its position there, and its rank by IDF in the phrase.

A file's licence words are looked up in the index with their positions.  A key phrase
stands only where all of its words do, so a file's highest-IDF words of a template are those
of the whole phrase, and postings of the ``RARE_WORDS`` highest ranks are enough: those of
rank 0 and of each further rank are turned into starts (template, file position less
position in the phrase) and intersected, for all templates in one go.  What is left is
verified against the key phrase, so every place is found and none is wrong.

Templates and index are data, a hash table of postings in one constant, so the plan is the
same for ten templates and for ten thousand.  Two map-only passes (frequencies, scan);
only word counts are shuffled.  DataFrame expressions only.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import fresh, lower_ascii, ref
from eventide.llm.licence_texts import NOTICES

#: Words: letters and digits of ASCII, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Index words per key phrase.
RARE_WORDS = 2


#: Rows of the index's hash table for each of its words.
SPACE = 4
#: A start is a long: the template's number, and the start plus OFFSET in the low 32 bits.
SHIFT, OFFSET = 32, 1 << 30


def plain_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text))


class Template(NamedTuple):
    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return plain_words(self.notice)

    @property
    def key_words(self) -> list[str]:
        return plain_words(self.key)

    @property
    def key_at(self) -> int:
        """Position of the key phrase in the notice."""
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key_words)


TEMPLATES = tuple(Template(*n) for n in NOTICES)


def constant(value: object, kind: str) -> Column:
    """A nested value as one constant of the plan."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {kind}")["v"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def inverse_frequencies(df: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, float]:
    """IDF of each vocabulary word over all rows; words are deduplicated within a
    document before they are counted, and counts are combined before the shuffle."""
    total = df.count()
    found = (df.select(F.explode(F.array_intersect(words_of(ref(text)), constant(list(vocabulary), "array<string>"))).alias("word"))
             .groupBy("word").count().collect())
    seen = {r["word"]: r["count"] for r in found}
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def index_words(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the key phrase, with their positions in it; a phrase of fewer
    words repeats its last one, so that every template has postings of every rank."""
    first = {w: i for i, w in reversed(list(enumerate(template.key_words)))}
    found = sorted(first.items(), key=lambda x: (-idf[x[0]], x[1]))[:RARE_WORDS]
    return found + found[-1:] * (RARE_WORDS - len(found))


def hash_table(templates: Sequence[Template], idf: dict[str, float]) -> list[list[dict]]:
    """Postings by word, as rows of entries: a word is in the row of its hash."""
    postings: dict[str, list[dict]] = {}
    for number, template in enumerate(templates):
        for rank, (word, at) in enumerate(index_words(template, idf)):
            postings.setdefault(word, []).append({"rank": rank, "start": (number << SHIFT) + OFFSET - at})
    rows: list[list[dict]] = [[] for _ in range(SPACE * len(postings) + 1)]
    for word, found in postings.items():
        rows[xxhash.xxh64_intdigest(word.encode(), 42) % len(rows)].append({"word": word, "postings": found})
    return rows


def licence_scan(df: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """Add ``n_words`` and ``hits``: an array of (template number, start of the key
    phrase in words from 0, share of the notice's words in place), by template and start.

    A null or empty text has no words and no hits.  Rows are independent: ties
    and repeated rows give equal results; an empty table gives an empty result.
    Columns called ``n_words`` / ``hits`` are replaced.
    """
    vocabulary = sorted({w for t in templates for w in t.key_words})
    idf = inverse_frequencies(df, vocabulary, text)
    rows = hash_table(templates, idf)
    table = constant(rows, "array<array<struct<word:string,postings:array<struct<rank:int,start:bigint>>>>>")
    known = constant([{"words": t.words, "key": t.key_words, "at": t.key_at} for t in templates],
                     "array<struct<words:array<string>,key:array<string>,at:int>>")
    looked_up = constant(sorted({e["word"] for row in rows for e in row}), "array<string>")
    words, rare, places = (fresh(df.columns, n) for n in ("words", "rare", "places"))

    def postings(word: Column) -> Column:
        """The index's entry of a word; null without one."""
        # unsigned remainder of the hash
        h = F.xxhash64(word)
        low = F.pmod(h, F.lit(len(rows)))
        row = F.when(h >= 0, low).otherwise(F.pmod(low + (1 << 64) % len(rows), F.lit(len(rows))))
        entries = F.get(table, row.cast("int"))
        return F.when(F.size(entries) > 0, F.get(F.filter(entries, lambda e: e["word"] == word), F.lit(0))["postings"])

    def starts(found: Column, rank: int) -> Column:
        """template and start as one long, of the postings of a rank."""
        return F.flatten(F.transform(found, lambda f: F.transform(
            F.filter(f["postings"], lambda p: p["rank"] == rank), lambda p: p["start"] + f["at"])))

    def stands(place: Column) -> Column:
        t = F.get(known, F.shiftright(place, SHIFT).cast("int"))
        start = place.bitwiseAND(F.lit((1 << SHIFT) - 1)) - OFFSET
        return F.when(start >= 0, F.slice(F.col(words), F.greatest(start, F.lit(0)).cast("int") + 1, F.size(t["key"])) == t["key"]).otherwise(False)

    def hit(place: Column) -> Column:
        t = F.get(known, F.shiftright(place, SHIFT).cast("int"))
        start = (place.bitwiseAND(F.lit((1 << SHIFT) - 1)) - OFFSET).cast("int")
        right = F.filter(F.sequence(F.lit(0), F.size(t["words"]) - 1), lambda j: F.coalesce(
            F.when(start - t["at"] + j >= 0, F.get(F.col(words), start - t["at"] + j)) == F.get(t["words"], j), F.lit(False)))
        return F.struct(F.shiftright(place, SHIFT).cast("int").alias("template"), start.alias("start"),
                        (F.size(right) / F.size(t["words"]).cast("double")).alias("share"))

    none = F.array().cast("array<struct<template:int,start:int,share:double>>")
    out = df.withColumn(words, words_of(ref(text)))
    if not templates:
        return out.withColumns({"n_words": F.size(words).cast("long"), "hits": none}).drop(words)
    out = out.withColumn(rare, F.when(F.arrays_overlap(words, looked_up), F.filter(
        F.transform(words, lambda w, i: F.struct(postings(w).alias("postings"), i.alias("at"))), lambda f: f["postings"].isNotNull())))
    agreed = reduce(F.array_intersect, [starts(F.col(rare), rank) for rank in range(RARE_WORDS)])
    out = out.withColumn(places, F.when(F.size(rare) > 0, F.array_sort(F.filter(agreed, stands))))
    hits = F.coalesce(F.transform(places, hit), none)
    return out.withColumns({"n_words": F.size(words).cast("long"), "hits": hits}).drop(words, rare, places)


def labels_of(hits: Column, templates: Sequence[Template] = TEMPLATES, base_only: bool = False) -> Column:
    """Distinct labels of the hits, sorted and comma-joined."""
    names = constant([t.label for t in templates], "array<string>")
    kept = F.filter(hits, lambda h: h["template"].isin(base_numbers(templates))) if base_only else hits
    return F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.get(names, h["template"])))), ",")


def base_numbers(templates: Sequence[Template] = TEMPLATES) -> list[int]:
    return [i for i, t in enumerate(templates) if t.base]
