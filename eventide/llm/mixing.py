"""Mixing sources to target weights by systematic sampling.

A source's target share of all words follows its weight, but stops at
``MAX_REPEAT`` times the source's own size; the excess is reshared by weight
until no target is above its stop.  Target over size is the expected number of
copies of each of the source's documents.  Those are prefix-summed within the
source, one offset of the source is added, and a document is emitted once for
each integer that its step of the sum crosses.  Documents are summed in order of
size, so every size is drawn alike and the words taken come near the target.

The prefix is not one long window per source: rows are ranked within (source,
size class, slice by a hash of id and size), of which there are the more the longer
the table is, and the ranks begin after the rows of all earlier groups, whose counts
are a small table.  One
shuffle of (id, source, size) rows; texts are not moved.  The offset is a hash of
the source and the seed, so reruns agree.  DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import fresh, ref

#: The weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MAX_REPEAT = 3
#: Rows of a slice of a (source, size class) at most, on average: there are as many slices
#: as the table has such parts, so one source may hold all rows.
SLICE_ROWS = 1 << 18
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source``, ``source_size`` -> plus ``target``: weighted filling up to the stops.

    With sources by stop per weight, those before the first that its fair share
    of the rest does not fill are at their stops; the others share what is left
    by weight.  That share per weight grows up to there and falls from there on, so
    it is the largest of those that fit.  One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights) + 1
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), at))
    w = w.withColumn("stop", F.col("source_size") * F.lit(float(max_repeat)))
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("fill", rest / left)  # words per weight if only the earlier ones are at their stops
    w = w.withColumn("level", F.max(F.when(F.col("fill") * F.col("weight") <= F.col("stop"), F.col("fill"))).over(all_rows))
    return w.select("source", "source_size", F.least("stop", F.coalesce(F.col("level") * F.col("weight"), F.col("stop"))).alias("target"))


def offset(source: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) fixed by source and seed; the null source has its own."""
    text = F.coalesce(F.concat(F.lit(f"{seed}:s"), source), F.lit(f"{seed}:null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sampled(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text",
            weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, slice_rows: int = SLICE_ROWS,
            seed: int = SEED) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``source_size``, ``target`` (its source's) and
    ``copies``.

    Null texts have size 0, the null source is a source of its own (last in
    order), null ids come first within their group.  A source without words has
    target 0 and no copies.  Rows that repeat an id are ranked by size; equal
    rows are interchangeable.  An empty table gives an empty result.
    """
    return _copies(_rows(df, row_id, source, text), slices_of(df, slice_rows), weights, max_repeat, seed).select(
        "doc_id", "size", "source_size", "target", "copies")


def slices_of(df: DataFrame, slice_rows: int = SLICE_ROWS) -> int:
    return max(1, -(-df.count() // slice_rows))


def slice_of(slices: int) -> Column:
    """A hash of id and size that SQL has too, so that neither ids in steps nor rows that
    share an id meet in one slice."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % F.lit(slices)


def _rows(df: DataFrame, row_id: str, source: str, text: str, *more: Column) -> DataFrame:
    return df.select(ref(row_id).alias("doc_id"), ref(source).alias("source"), word_count(ref(text)).alias("size"), *more)


def _copies(rows: DataFrame, slices: int, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT,
            seed: int = SEED, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` (doc_id, source, size and ``ties``, which order rows of equal size
    and id) plus source_size, target and copies."""
    kept = rows.columns
    size_class = F.floor(F.log2(F.col("size") + F.lit(1.0)) * 4)
    rows = rows.withColumns({"class": size_class, "slice": slice_of(slices)})
    group = ["source", "class", "slice"]
    counted = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    sizes = counted.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    earlier = Window.partitionBy("source").orderBy("class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("a").join(
        targets.alias("b"), F.expr("a.source <=> b.source")).select(
        *[F.col(f"a.{c}") for c in (*group, "before")], "source_size", "target")
    order = Window.partitionBy(*group).orderBy("size", F.col("doc_id").asc_nulls_first(), *ties)
    ranked = rows.withColumn("rank", F.row_number().over(order)).alias("a")
    same = F.expr("a.source <=> b.source AND a.class = b.class AND a.slice = b.slice")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at, u = F.col("before") + F.col("rank"), offset(F.col("a.source"), seed)
    copies = F.floor(rate * at + u) - F.floor(rate * (at - 1) + u)
    return ranked.join(starts.alias("b"), same).select(
        *[F.col(f"a.{c}") for c in kept], "source_size", "target", copies.cast("long").alias("copies"))


def _row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the row; maps, which have no hash, as JSON."""
    kinds = dict(df.dtypes)
    values = [F.to_json(F.struct(ref(c))) if "map<" in kinds[c] else ref(c) for c in columns]
    # the hash skips nulls, so where they stand goes in as well
    nulls = F.concat(*[F.when(ref(c).isNull(), "0").otherwise("1") for c in columns])
    return [F.xxhash64(F.lit(i), nulls, *values) for i in range(2)]


def mixed(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", slice_rows: int = SLICE_ROWS, **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as its copies say, with the
    number of the copy (from 1) in a column ``copy``; a column ``copy`` that was
    there is replaced.  Rows of equal source, size and id are ranked by a hash of
    the row, so each has copies of its own.  Rows equal in all columns are one row
    with the sum of their copies, numbered as if dealt to them in turn."""
    kept = [c for c in df.columns if c.lower() != "copy"]
    key = ["doc_id", "source", "size", "hash_a", "hash_b"]
    names = {n: fresh(df.columns, n) for n in (*key, "copies", "rows")}
    other = {n: fresh(df.columns, f"own_{n}") for n in key}
    hashes = [h.alias(names[n]) for n, h in zip(("hash_a", "hash_b"), _row_hashes(df, kept), strict=True)]
    told = df.select(*map(ref, kept), *hashes)
    rows = _rows(told, row_id, source, text, *[ref(names[n]).alias(n) for n in ("hash_a", "hash_b")])
    taken = _copies(rows, slices_of(df, slice_rows), **options, ties=("hash_a", "hash_b")).groupBy(*key).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    taken = taken.select(*[F.col(n).alias(other[n]) for n in key], *[F.col(n).alias(names[n]) for n in ("copies", "rows")])
    own = [ref(row_id), ref(source), word_count(ref(text)), ref(names["hash_a"]), ref(names["hash_b"])]
    joined = told.join(taken, reduce(and_, [c.eqNullSafe(F.col(other[n])) for n, c in zip(key, own, strict=True)]))
    copies, n_rows = F.col(names["copies"]), F.col(names["rows"])
    one = joined.where(n_rows == 1).select(*map(ref, kept), F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy"))
    # equal rows collapse by partial aggregation, however many there are
    packed = F.struct(*[ref(c).alias(f"c{i}") for i, c in enumerate(kept)])
    many = joined.where(n_rows > 1).groupBy(*[F.col(other[n]) for n in key], copies, n_rows).agg(
        F.first(packed).alias("row"))
    turns = F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), lambda k: F.floor(k / n_rows).cast("int") + 1)
    many = many.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.explode(turns).alias("copy"))
    return one.union(many)
