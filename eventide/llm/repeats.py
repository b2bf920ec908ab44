"""Repeated-substring removal with Burrows-Wheeler transforms of shards.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(in a document with a smaller id, or earlier in its own).  Rows that share an id are
told apart by a hash of their texts, their *version*.

1. *Fragments* (one pass).  Every string of ``length`` bytes belongs to the shard
   of its smallest k-byte gram (by a hash, the leftmost of equals), so equal
   strings share a shard whatever documents they lie in.  Consecutive strings with
   the same gram form a fragment, told by gram hash, content hash and place.  Of
   fragments that are equal in content only the earliest can hold a first
   occurrence; the others are marked at once, within a batch before the shuffle
   and then within the shard.  A huge group of copies so shrinks to a row per batch.
2. *Shards.*  Fragments of one gram that differ in content may still share a
   string, but only if they agree in the bytes on one side of the gram (half of
   what a string has beside it).  The bytes of those that agree with another in a
   hash of either side are cut from the texts and dealt by gram.
3. *Transform.*  A task joins its shards' fragments into one text, sorts its
   rotations by their first ``length`` bytes or more, and expands intervals of
   the Burrows-Wheeler transform by backward extension, breadth first: round l
   finds every border between neighbours whose common prefix is l bytes, so the
   common prefixes come by increasing value and the search stops at ``length``.
   Neighbours without a border by then share a string; all but the earliest are
   marked.
4. *Cut.*  The marked spans meet the texts by id.

A very common line shorter than a string gives its gram a fragment for each of its
surroundings.  Such *hot* grams are found beforehand, from the fragments of a hash
sample of texts; their fragments are dealt as single strings, by two hashes of the
whole string, and meet like other fragments of equal content, so no shard grows with
the line.  The sample only says how strings are dealt, not which of them are equal.

Texts are shuffled once (both joins use the same exchange), with 20-odd bytes for
each 40 bytes of text for the fragments.  Tasks read their shards as a stream sorted by
gram and hold a bounded number of rows and one gram's fragments at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from eventide.llm.common import fresh, ref, shared_folder

LENGTH = 100
GRAM = 24
#: Bytes handled at once in a pass over texts, and in one transform.
PIECE, TRANSFORM = 2 << 20, 1 << 18
#: A gram is hot if it has over HOT_FRAGMENTS different fragments, or one of HOT_PARTS
#: parts of all if that is more, as far as one of SAMPLE texts tell: so at most HOT_PARTS
#: grams are hot, and the list is small enough to be broadcast.
HOT_FRAGMENTS, HOT_PARTS, SAMPLE = 256, 1 << 20, 16
#: Rows of whole grams that a task looks at together.
CHUNK = 1 << 18
SEPARATOR = 0xFF  # no byte of UTF-8
POSITION_BITS = 28  # positions in a piece, below the hash in a sort key
UNSET = -1
#: ``at`` of a row holds its number of starts in so many bits below the start; a
#: fragment has fewer starts than a string has bytes.
COUNT = 1 << 20


# ---------------------------------------------------------------- fragments

BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def gram_hashes(data: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """64-bit hash of the ``size`` bytes from each position (polynomial, mixed)."""
    h = np.zeros(len(data) - size + 1, np.uint64)
    power, have, block = base, 0, (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        span = 1
        while True:  # block: hashes of ``span`` bytes; the binary digits of size add them up
            if size & span:
                h = h * np.uint64(power) + block[have:have + len(h)]
                have += span
            if span * 2 > size:
                break
            block = block[:-span] * np.uint64(power) + block[span:]
            power, span = power * power % 2**64, span * 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def window_min(keys: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive keys, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        keys = np.minimum(keys[:-step], keys[step:])
        have += step
    return keys


def fragments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Fragments of the concatenated texts that end at ``ends``: first start, number
    of starts, gram hash, and the hashes (32 bits each, 0 for none) of the bytes on
    the gram's left and right.  A string has the whole left side if it starts early
    enough, else the whole right one."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, np.empty(0, np.uint64), none
    hashes = gram_hashes(data, GRAM)
    low = np.uint64((1 << POSITION_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    least = (window_min(keys, length - GRAM + 1) & low).astype(np.int64)
    within = np.ones(len(least), bool)  # strings that do not cross an end
    for e in ends[:-1].tolist():
        within[max(0, e - length + 1):e] = False
    at = np.flatnonzero(within)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(least[at]) != 0)
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    start = at[first]
    gram, side = least[start], (length - GRAM) // 2
    if not side:
        return start, counts, hashes[gram], np.full(len(start), 1 << 32 | 1, np.int64)
    sides = gram_hashes(data, side) >> np.uint64(33) | np.uint64(1)
    left = np.where(start <= gram - side, sides[np.maximum(gram - side, 0)], 0)
    right = np.where(start + counts > gram - side + 1, sides[np.minimum(gram + GRAM, len(sides) - 1)], 0)
    return start, counts, hashes[gram], (left << np.uint64(32) | right).astype(np.int64)


def pieces(ids: list, texts: list[bytes], length: int) -> Iterator[tuple[list, list[int], list[bytes]]]:
    """(ids, offsets, bytes) of at most about PIECE bytes; longer texts in parts that
    overlap by length - 1 bytes, so that every string lies in one part."""
    group: tuple[list, list[int], list[bytes]] = ([], [], [])
    held = 0
    for i, t in zip(ids, texts, strict=True):
        for s in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[s:s + PIECE + length - 1]
            if held and held + len(part) > PIECE:
                yield group
                group, held = ([], [], []), 0
            group[0].append(i)
            group[1].append(s)
            group[2].append(part)
            held += len(part)
    if held:
        yield group


def merged_spans(doc: np.ndarray, ver: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of the byte spans of each version of a document."""
    if not len(doc):
        return doc, ver, start, size
    o = np.lexsort((start, ver, doc))
    doc, ver, start, end = doc[o], ver[o], start[o], (start + size)[o]
    # running maximum of the ends within a version: shift versions apart
    place = np.cumsum(np.append(0, (np.diff(doc) != 0) | (np.diff(ver) != 0))) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + place)
    new = np.ones(len(doc), bool)
    new[1:] = (start + place)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], ver[first], start[first], (reach - place)[last] - start[first]


def spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Some even key for rows that need no company."""
    with np.errstate(over="ignore"):
        return (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ start.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def firsts(*keys: np.ndarray, doc: np.ndarray, ver: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows to keep of each group of equal keys (one for each version at the group's
    first place), and the rows at a later place."""
    order = np.lexsort((ver, start, doc, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    d, v, s = doc[order], ver[order], start[order]
    later = (d != d[head]) | (s != s[head])
    new[1:] |= v[1:] != v[:-1]
    return order[new & ~later], order[later]


#: Rows of the first pass: fragments (n > 0) with gram and content hash, and marked
#: spans (n = 0), whose size stands for the content hash.  ``at`` = start * COUNT + n;
#: ``sides`` = left * 2^32 + right, 0 for single strings, which match by their hashes only.
ROWS = "gram long, content long, doc long, ver long, at long, sides long"
ROW_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in ROWS.split(", ")])


def rows_of(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=ROW_SCHEMA)


def span_rows(doc: np.ndarray, ver: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    doc, ver, start, size = merged_spans(doc, ver, start, size)
    return rows_of(spread(doc, start), size, doc, ver, start * COUNT, np.zeros(len(doc), np.int64))


def as_bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values the sorted array ``known`` holds."""
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def singles(data: np.ndarray, first: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, two hashes) of each string of the fragments."""
    start = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
    return start, gram_hashes(data, length)[start], gram_hashes(data, length, OTHER_BASE)[start]


def fragment_rows(batches: Iterable[pa.RecordBatch], length: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Fragments of (id, version, text), those of the hot grams (sorted) as single strings."""
    for batch in batches:
        known = batch.filter(batch.column(0).is_valid())
        found: list[tuple[np.ndarray, ...]] = []
        numbers = np.arange(known.num_rows)
        ids, versions = (known.column(i).to_numpy() for i in range(2))
        for own, offsets, texts in pieces(numbers.tolist(), as_bytes(known.column(2)), length):
            joined = b"".join(texts)
            data, ends = np.frombuffer(joined, np.uint8), np.cumsum([len(t) for t in texts])
            first, n, gram, sides = fragments(data, ends, length)
            common = is_in(gram, hot)
            loose = singles(data, first[common], n[common], length) if common.any() else None
            first, n, gram, sides = (x[~common] for x in (first, n, gram, sides))
            view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
            content = np.array([digest(view[s:e]) for s, e in zip(first.tolist(), (first + n + length - 1).tolist(), strict=True)], np.uint64)
            if loose:
                at, one, other = loose
                first, gram, content = np.append(first, at), np.append(gram, one), np.append(content, other)
                n, sides = np.append(n, np.ones(len(at), np.int64)), np.append(sides, np.zeros(len(at), np.int64))
            text = np.searchsorted(ends, first, side="right")
            start = first - np.append(0, ends)[text] + np.array(offsets, np.int64)[text]
            found.append((gram, content, np.array(own, np.int64)[text], start, n, sides))
        if found:
            gram, content, row, start, n, sides = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, ver = ids[row], versions[row]
            one, late = firsts(gram, content, doc=doc, ver=ver, start=start)
            yield rows_of(gram[one].view(np.int64), content[one].view(np.int64), doc[one], ver[one], start[one] * COUNT + n[one], sides[one])
            yield span_rows(doc[late], ver[late], start[late], n[late] + length - 1)


def gram_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(gram, content) of the fragments, for the count of the sample."""
    for rows in fragment_rows(batches, length, np.empty(0, np.uint64)):
        own = rows.filter(pa.array(rows.column(4).to_numpy() % COUNT != 0))
        yield pa.RecordBatch.from_arrays([own.column(0), own.column(1)], ["gram", "content"])


def met_again(gram: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Rows whose (gram, side) another row has too; side 0 is none."""
    order = np.lexsort((side, gram))
    g, s = gram[order], side[order]
    same = (g[1:] == g[:-1]) & (s[1:] == s[:-1]) & (s[1:] != 0)
    out = np.zeros(len(gram), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def chunks(batches: Iterable[pa.RecordBatch], schema: pa.Schema, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows, none of which ends within a gram, of batches sorted by
    gram."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            gram = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            if cut:  # the batch's last gram may go on
                yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)], schema)
                held = [batch.slice(cut)]
    yield pa.Table.from_batches(held, schema)


SPANS = "doc long, ver long, start long, size long, gram long, n int"


def shard_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marked spans (size set), and the fragments whose bytes are needed (gram and n set)."""
    for whole in chunks(batches, ROW_SCHEMA, CHUNK):
        gram, content, doc, ver, at, sides = (whole.column(i).to_numpy() for i in range(6))
        done = at % COUNT == 0
        spans = [(doc[done], ver[done], at[done] // COUNT, content[done])]
        gram, content, doc, ver, start, n, sides = (x[~done] for x in (gram, content, doc, ver, at // COUNT, at % COUNT, sides))
        one, late = firsts(gram, content, doc=doc, ver=ver, start=start)
        spans.append((doc[late], ver[late], start[late], n[late] + length - 1))
        gram, sides = gram[one], sides[one]
        wanted = met_again(gram, sides >> 32) | met_again(gram, sides & 0xFFFFFFFF)
        doc, ver, start, gram, n = doc[one][wanted], ver[one][wanted], start[one][wanted], gram[wanted], n[one][wanted]
        names = ["doc", "ver", "start", "size", "gram", "n"]
        marked = merged_spans(*(np.concatenate(x) for x in zip(*spans, strict=True)))
        k = len(marked[0])
        yield pa.RecordBatch.from_arrays([*map(pa.array, marked), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32())], names)
        yield pa.RecordBatch.from_arrays([*map(pa.array, (doc, ver, start)), pa.nulls(len(doc), pa.int64()), pa.array(gram), pa.array(n, pa.int32())], names)


CUTS = "gram long, doc long, ver long, start long, bytes binary"
CUT_SCHEMA = pa.schema([*[(c, pa.int64()) for c in ("gram", "doc", "ver", "start")], ("bytes", pa.binary())])


def cut_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted fragments of each text (columns id, version, text, wanted)."""
    for batch in batches:
        has = batch.filter(batch.column(3).is_valid())
        rows = [(f["gram"], i, v, f["start"], t[f["start"]:f["start"] + f["n"] + length - 1])
                for i, v, t, own in zip(has.column(0).to_pylist(), has.column(1).to_pylist(), as_bytes(has.column(2)), has.column(3), strict=True)
                for f in own.as_py()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(CUT_SCHEMA.types)], schema=CUT_SCHEMA)


# ---------------------------------------------------------------- transform

def sorted_rotations(text: np.ndarray, length: int) -> np.ndarray:
    """Starts of the text's rotations, ordered by their first ``length`` bytes at
    least (prefix doubling; equal beginnings in any order)."""
    key, width = text.astype(np.uint64), 1
    while width < 8:
        key = key << np.uint64(8 * width) | np.roll(key, -width)
        width *= 2
    while True:
        order = np.argsort(key)
        if width >= length:
            return order
        s = key[order]
        rank = np.empty(len(text), np.uint64)
        rank[order] = np.cumsum(np.append(False, s[1:] != s[:-1])).astype(np.uint64)
        key = rank << np.uint64(32) | np.roll(rank, -width)
        width *= 2


def prefix_borders(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place i of the order: the common prefix with place i - 1 if it is below
    ``length``, else UNSET.  Round l backward-extends the intervals that round l - 1
    has found; an extension whose end is not yet known ends a common prefix of l."""
    n = len(text)
    before = text[order - 1]  # the transform
    by_byte = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)  # place of the rotation that starts one byte earlier
    back[by_byte] = np.arange(n)
    head = text[order]
    common = np.full(n + 1, UNSET, np.int16 if length < 1 << 15 else np.int32)
    common[0] = common[n] = 0
    lo, hi = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for value in range(length):
        one = hi - lo == 1
        new_lo = back[lo[one]]
        new_hi = new_lo + 1
        lo, size = lo[~one], (hi - lo)[~one]
        if len(lo):
            own = np.repeat(np.arange(len(lo)), size)
            at = np.arange(len(own)) + np.repeat(lo - np.append(0, np.cumsum(size)[:-1]), size)
            to = back[at]
            o = np.argsort(to)
            to, own = to[o], own[o]
            byte = head[to]
            ends = np.append((own[1:] != own[:-1]) | (byte[1:] != byte[:-1]), True)
            last = np.flatnonzero(ends)
            new_lo = np.append(new_lo, to[np.append(0, last[:-1] + 1)])
            new_hi = np.append(new_hi, to[last] + 1)
        fresh_end = common[new_hi] == UNSET
        if value == 0:  # the whole text's extensions: the last one ends at n
            fresh_end |= new_hi == n
        lo, hi = new_lo[fresh_end], new_hi[fresh_end]
        common[hi] = value
        if not len(lo):
            break
    return common[:n]


def later_strings(doc: np.ndarray, ver: np.ndarray, start: np.ndarray, cut: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(doc, ver, start) of the strings of the fragments that occur at an earlier place in
    these fragments."""
    text = np.frombuffer(bytes([SEPARATOR]).join([*cut, b""]), np.uint8)
    order = sorted_rotations(text, length)
    group = np.cumsum(prefix_borders(text, order, length) != UNSET)
    sizes = np.array([len(x) for x in cut])
    begins = np.append(0, np.cumsum(sizes + 1)[:-1])
    own = np.searchsorted(begins, order, side="right") - 1
    inside = order - begins[own]
    ok = inside + length <= sizes[own]
    group, own, inside = group[ok], own[ok], inside[ok]
    place = start[own] + inside
    _, late = firsts(group, doc=doc[own], ver=ver[own], start=place)
    return doc[own][late], ver[own][late], place[late]


def repeat_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marked spans of a partition's shards, which come sorted by gram; transforms take
    whole shards, of about TRANSFORM bytes together."""
    for whole in chunks(batches, CUT_SCHEMA, TRANSFORM // length):
        gram, doc, ver, start = (whole.column(c).to_numpy() for c in ("gram", "doc", "ver", "start"))
        cut = whole.column("bytes").to_pylist()
        ends = np.flatnonzero(np.append(np.diff(gram) != 0, True)) + 1 if len(gram) else gram
        held, s = np.cumsum([0, *map(len, cut)]), 0
        for k, e in enumerate(ends.tolist()):
            if k + 1 == len(ends) or held[ends[k + 1]] - held[s] > TRANSFORM:
                d, v, at = later_strings(doc[s:e], ver[s:e], start[s:e], cut[s:e], length)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged_spans(d, v, at, np.full(len(d), length))],
                                                 ["doc", "ver", "start", "size"])
                s = e


# ---------------------------------------------------------------- operator

def versioned(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, ver, text) of the rows: ids are integers, and a text's hash tells rows apart
    that share an id."""
    if not isinstance(df.schema[row_id].dataType, IntegralType):
        raise TypeError(f"{row_id} must be an integer column")
    return df.select(ref(row_id).cast("long").alias("id"), version(text).alias("ver"), ref(text).alias("text"))


def version(text: str) -> Column:
    return F.xxhash64(F.coalesce(ref(text), F.lit("")))


def hot_grams(rows: DataFrame, length: int, hot: int) -> np.ndarray:
    """Hashes of the hot grams, sorted."""
    grams = rows.where(F.pmod(F.xxhash64("id", "ver"), F.lit(SAMPLE)) == 0).mapInArrow(lambda b: gram_rows(b, length), "gram long, content long")
    kinds = grams.distinct().groupBy("gram").count()
    most = kinds.select(F.struct("count", "gram").alias("c")).groupBy().agg(
        F.sum("c.count").alias("all"), F.max("c.count").alias("most")).first()
    least = max(hot / SAMPLE, (most["all"] or 0) / HOT_PARTS)
    if not most["most"] or most["most"] <= least:
        return np.empty(0, np.uint64)
    found = kinds.where(F.col("count") > least).select("gram").toPandas()["gram"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def repeated_spans(df: DataFrame, row_id: str, text: str, length: int = LENGTH, hot: int = HOT_FRAGMENTS) -> DataFrame:
    """(doc, ver, spans): the byte spans to remove of each version of a document that has
    any, as an array of start * 2^32 + size; they may overlap."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} at least")
    if length >= COUNT:
        raise ValueError(f"length must be below {COUNT}")
    spark = df.sparkSession
    rows = versioned(df, row_id, text)
    common = spark.sparkContext.broadcast(hot_grams(rows, length, hot))
    told = rows.mapInArrow(lambda b: fragment_rows(b, length, common.value), ROWS)
    folder = f"{shared_folder(spark)}/repeats-{uuid.uuid4().hex}"
    told.repartition("gram").sortWithinPartitions("gram").mapInArrow(lambda b: shard_rows(b, length), SPANS).write.parquet(folder)
    spans = spark.read.parquet(folder)
    wanted = spans.where("n IS NOT NULL").groupBy("doc", "ver").agg(F.collect_list(F.struct("gram", "start", "n")).alias("wanted"))
    cuts = joined(df, row_id, text, wanted, "wanted", lambda d, c: d.select(
        ref(row_id).cast("long").alias("id"), version(text).alias("ver"), ref(text).alias("text"), ref(c).alias("wanted"))
        .mapInArrow(lambda b: cut_rows(b, length), CUTS))
    dealt = cuts.repartition("gram").sortWithinPartitions("gram")
    more = dealt.mapInArrow(lambda b: repeat_rows(b, length), "doc long, ver long, start long, size long")
    every = spans.where("size IS NOT NULL").select("doc", "ver", "start", "size").unionByName(more)
    packed = F.shiftleft("start", 32) + F.col("size")
    return every.groupBy("doc", "ver").agg(F.collect_list(packed).alias("spans"))


def joined(df: DataFrame, row_id: str, text: str, lists: DataFrame, name: str, then) -> DataFrame:
    """``then`` of ``df`` with the list of each row's id and version (null without one); the
    texts are not sorted for it, the lists are the hashed side."""
    own, ver, column = (fresh(df.columns, n) for n in ("doc", "ver", name))
    right = lists.select(F.col("doc").alias(own), F.col("ver").alias(ver), F.col(name).alias(column)).hint("shuffle_hash")
    same = (ref(row_id).cast("long") == F.col(own)) & (version(text) == F.col(ver))
    return then(df.join(right, same, "left").drop(own, ver), column)


def kept_mask(n: int, spans: np.ndarray | None) -> np.ndarray:
    keep = np.ones(n, bool)
    for x in [] if spans is None else np.asarray(spans, np.int64).tolist():
        keep[x >> 32:(x >> 32) + (x & 0xFFFFFFFF)] = False
    return keep


def kept_bytes(text: str | None, spans: np.ndarray | None) -> tuple[bytes, bytes, int]:
    """The text's bytes, those that stay, and the number of maximal removed runs."""
    raw = (text or "").encode()
    if spans is None:
        return raw, raw, 0
    keep = kept_mask(len(raw), spans)
    runs = int(np.count_nonzero(np.diff(np.append(True, keep).astype(np.int8)) < 0))
    return raw, np.frombuffer(raw, np.uint8)[keep].tobytes(), runs


def repeat_report(df: DataFrame, row_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_sha256`` of the bytes that stay.

    Ids are integers.  A null text is empty.  Rows without an id are neither searched nor
    cut.  Rows that share an id are versions of one document: a string that stands in
    another of them at the same place isn't earlier, one before it is; each loses its
    own repeats only, and equal rows lose the same.  Texts shorter than ``length`` stay
    whole.  An empty table gives an empty result.
    """
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def told(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, spans, strict=True):
            raw, kept, runs = kept_bytes(t, s)
            out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = repeated_spans(df, row_id, text, length)
    return joined(df, row_id, text, found, "spans", lambda d, c: d.select(
        ref(row_id).alias("doc_id"), told(ref(text), ref(c)).alias("told")).select("doc_id", "told.*"))


def without_repeats(df: DataFrame, row_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with its repeats cut out of ``text``; rows and columns stay, and so do
    null texts.  Bytes left of a character that a cut splits are dropped.  An
    integer column ``n_chars`` is brought up to date.  Edge cases as in
    ``repeat_report``."""
    @F.pandas_udf(StringType())
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else kept_bytes(t, s)[1].decode(errors="ignore")
                          for t, s in zip(texts, spans, strict=True)], dtype=object)

    found = repeated_spans(df, row_id, text, length)
    out = joined(df, row_id, text, found, "spans", lambda d, c: d.withColumn(text, cut(ref(text), ref(c))).drop(c))
    for name, kind in df.dtypes:
        if name == "n_chars" and kind in ("int", "bigint"):
            out = out.withColumn(name, F.length(ref(text)).cast(kind))
    return out.select(*map(ref, df.columns))
