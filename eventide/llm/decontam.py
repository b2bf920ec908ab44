"""Benchmark decontamination by SimHash of item-sized windows.

An item of L words is sought in windows of L words (the whole text, if it is shorter).  A
similarity of ``SIMILARITY`` asks for a number m of common shingles, so all windows that
cannot reach it are left out by counting, which loses none:

1. *Rare shingles.*  Of an item's n shingles any n - m + 1 must meet every window that is
   similar, so only its rarest, by the number of items that have them, are looked up at each
   place of each text.  Wording that many items share is so left out.  The result is a
   place range per document and item; words are not carried along.
2. *Windows.*  The texts of these documents are read again, and every window with m
   places of the item's shingles is taken.
3. *Fingerprints.*  Each window gets a 64-bit SimHash of its shingles.  Fingerprints are found
   within ``RADIUS`` bits by a multi-index: cut into RADIUS + 1 blocks, two of them within
   the radius have an equal block, so windows and items of one length are joined by
   block and its bits, and no pair within the radius is lost.
4. *Verification.*  Pairs within the radius are verified with the exact weighted similarity of
   their shingles (sum of the smaller over sum of the larger counts).  At 0.8 a fingerprint
   differs in about 10 of 64 bits (standard deviation 3), so a radius of 20 keeps them.

The benchmark is the stated query set.  Its tables, and the place ranges, are broadcast if
their bytes, summed up beforehand, are under ``BROADCAST_BYTES``; else Spark shuffles both
sides: positions in the first step, texts once (by document) in the second.  Items' texts
join behind the radius test only.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import checkpointed, fresh, ref

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
#: Bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEXT_HASH = "text_hash"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def starts(words: Column, size: int) -> Column:
    """0 .. number of windows of ``size`` words - 1; empty if there is none."""
    return F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>"))


def shingle_hashes(words: Column, size: int) -> Column:
    return F.transform(starts(words, size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def shingles(words: Column, size: int = SHINGLE) -> Column:
    """The shingles as strings, repeats included; all words if they are fewer."""
    whole = F.array(F.array_join(words, " "))
    return F.when(F.size(words) <= size, whole).otherwise(
        F.transform(starts(words, size), lambda i: F.array_join(F.slice(words, i + 1, F.lit(size)), " ")))


def simhash(hashes: Column) -> Column:
    """Bit b is set if it is set in over half of the hashes."""

    def with_bit(acc: Column, b: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.call_function("getbit", h, b) == 1))
        return acc.bitwiseOR(F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))

    # never null, and said so: else Spark computes it again to filter nulls before the join
    return F.coalesce(F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit), F.lit(0).cast("long"))


def with_print(df: DataFrame, parts: str, name: str) -> DataFrame:
    """Add the SimHash of the shingles; their hashes are a column in between, as a
    lambda would compute them anew for each bit."""
    hashed = df.withColumn("hashes", F.transform(parts, lambda s: F.xxhash64(s)))
    return hashed.withColumn(name, simhash(F.col("hashes"))).drop("hashes")


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """radius + 1 blocks of the fingerprint as (number, bits)."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(
        F.lit((1 << (b - a)) - 1)).alias("bits")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger number of times, over all shingles."""
    def times(parts: Column, s: Column) -> Column:
        return F.size(F.filter(parts, lambda x: x == s))

    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, s: n + F.least(times(a, s), times(b, s)))
    return common / (F.size(a) + F.size(b) - common).cast("double")


def small(df: DataFrame, size: Column, limit: int) -> DataFrame:
    """``df``, broadcast if its rows' sizes sum up to no more than the limit."""
    total = df.agg(F.sum(size).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if (total or 0) <= limit else df


def row_bytes(columns: int) -> Column:
    """Size of a row of so many numbers."""
    return F.lit(8 * columns + 16)


def needed(n: Column, m: Column, similarity: float) -> Column:
    """Common shingles that n and m shingles need for the similarity."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(1e-9)).cast("int")


def rare_shingles(items: DataFrame, similarity: float) -> DataFrame:
    """(item, hash) of the shingles to look up: an item's rarest, until those that are left
    cannot make up a similar window.  A text shorter than the item has fewer shingles, all
    of which may match, so similarity * n common ones are the least."""
    each = items.select("item", "n", F.explode("item_hashes").alias("hash")).groupBy("item", "hash").agg(
        F.first("n").alias("n"), F.count("*").alias("times"))
    shared = each.groupBy("hash").agg(F.count("*").alias("items"))
    order = Window.partitionBy("item").orderBy("items", "hash").rowsBetween(Window.unboundedPreceding, -1)
    ranked = each.join(shared, "hash").withColumn("before", F.coalesce(F.sum("times").over(order), F.lit(0)))
    least = F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9))
    return ranked.where(F.col("before") <= F.col("n") - least).select("item", "hash")


def windows_of(pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """All windows of the pairs (columns of the document, its words, the item and the first and
    last place where they met) that have enough of the item's shingles, with their words."""
    n, length = F.col("n"), F.col("length")
    low = F.greatest(F.lit(0), F.col("first") - n + 1)
    cut = pairs.withColumns({"low": low, "total": F.size("doc_words"), "wide": F.least(length, F.size("doc_words"))})
    cut = cut.withColumns({"cut": F.slice("doc_words", F.col("low") + 1, F.col("last") + n + (size - 1) - F.col("low")), "own": F.col("wide") - (size - 1)})
    # few rows; written at each step, as Catalyst would put the columns into each other over and over
    cut = checkpointed(cut.drop("doc_words", "item", "first", "last"))
    cut = checkpointed(cut.withColumn("cut_hashes", shingle_hashes(F.col("cut"), size)))
    places = F.transform("cut_hashes", lambda h, i: F.when(F.array_contains("item_hashes", h), i))
    hit = cut.withColumns({"hits": F.filter(places, lambda i: i.isNotNull()), "m": needed(n, F.col("own"), similarity)})
    hit = checkpointed(hit.drop("cut_hashes", "item_hashes")).where((F.size("hits") >= F.col("m")) & (F.col("own") > 0))

    def range_of(i: Column) -> Column:
        """Starts of the windows that hold the i-th to the (i + m - 1)-th hit."""
        a = F.greatest(F.get("hits", i + F.col("m") - 1) - F.col("own") + 1, F.lit(0))
        b = F.least(F.get("hits", i), F.col("total") - F.col("wide") - F.col("low"))
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))

    at = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("hits") - F.col("m")), range_of)))
    found = hit.select("doc_id", TEXT_HASH, "length", "low", "wide", "cut", F.explode(at).alias("at"))
    return found.select("doc_id", TEXT_HASH, "length", (F.col("low") + F.col("at")).alias("start"),
                        F.slice("cut", F.col("at") + 1, F.col("wide")).alias("window"))


def leaks(df: DataFrame, benchmark: DataFrame, row_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document and item that it holds: ``doc_id``, ``text_hash``, ``item_id``,
    ``similarity``, ``start`` and ``n_words`` of the best window (the first of equals).

    Words are runs of letters and digits in small letters.  Null or empty texts and
    items without words match nothing; items of fewer words than a shingle are
    compared whole.  Repeated rows (equal id and text) are one document; rows that
    share an id only are told apart by ``text_hash``.  Rows without an id are searched
    too.  Ids are integers.  Empty tables give an empty result.
    """
    items = benchmark.select(ref(item_id).alias("item_id"), words_of(ref(item_text)).alias("words")).where(F.size("words") > 0).distinct()
    items = items.select(F.xxhash64("item_id", "words").alias("item"), "item_id", F.size("words").alias("length"), "words",
                         F.greatest(F.size("words") - (SHINGLE - 1), F.lit(1)).alias("n"), shingles(F.col("words")).alias("item_parts"))
    items = checkpointed(items.withColumn("k", F.least("length", F.lit(SHINGLE))))
    hashes = F.lit(None).cast("array<bigint>")
    for k in range(1, SHINGLE + 1):
        hashes = F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)).otherwise(hashes)
    items = checkpointed(items.withColumns({"item_hashes": hashes, "hashes": F.transform("item_parts", lambda s: F.xxhash64(s))}).drop("words"))
    items = checkpointed(items.withColumn("item_print", simhash(F.col("hashes"))).drop("hashes"))
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())

    own_hash = F.xxhash64(F.coalesce(ref(text), F.lit("")))
    windows = None
    for k in sizes:
        own = items.where(F.col("k") == k)
        sought = small(rare_shingles(own, similarity), row_bytes(2), broadcast_bytes)
        # the hashes are a column of their own: exploding it is generated code together with the join
        # (outer: else Spark hashes once more to filter empty arrays; the join drops their nulls)
        docs = df.select(ref(row_id).cast("long").alias("doc_id"), own_hash.alias(TEXT_HASH), words_of(ref(text)).alias("doc_words"))
        docs = docs.withColumn("hashes", shingle_hashes(F.col("doc_words"), k))  # of a column: else each hash splits the text anew
        places = docs.select("doc_id", TEXT_HASH, F.posexplode_outer("hashes").alias("at", "hash"))
        met = checkpointed(places.join(sought, "hash").groupBy("doc_id", TEXT_HASH, "item").agg(F.min("at").alias("first"), F.max("at").alias("last")))
        wanted = met.join(small(own.select("item", "length", "n", "item_hashes"), 8 * F.size("item_hashes") + row_bytes(4), broadcast_bytes), "item")
        wanted = wanted.withColumnsRenamed({"doc_id": "own_id", TEXT_HASH: "own_hash"})
        again = df.select(ref(row_id).cast("long").alias("doc_id"), own_hash.alias(TEXT_HASH), ref(text).alias("text"))
        same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col(TEXT_HASH) == F.col("own_hash"))
        pairs = again.join(small(wanted, 8 * F.size("item_hashes") + row_bytes(8), broadcast_bytes), same)
        found = windows_of(pairs.withColumn("doc_words", words_of(F.col("text"))).drop("text"), k, similarity)
        windows = found if windows is None else windows.unionByName(found)
    if windows is None:
        return df.sparkSession.createDataFrame([], f"doc_id long, {TEXT_HASH} long, item_id {dict(benchmark.dtypes)[item_id]}, "
                                                   "similarity double, start int, n_words int")
    windows = windows.groupBy("doc_id", TEXT_HASH, "length", "start").agg(F.first("window").alias("window"))
    windows = windows.select("doc_id", TEXT_HASH, "length", "start", F.size("window").alias("n_words"), shingles(F.col("window")).alias("parts"))
    windows = with_print(windows, "parts", "print")
    indexed = items.select("item", "item_print", "length", F.explode(blocks(F.col("item_print"), radius)).alias("key")).select(
        "item", "item_print", "length", "key.block", "key.bits")
    keyed = windows.select("*", F.explode(blocks(F.col("print"), radius)).alias("key")).select("*", "key.block", "key.bits").drop("key")
    near = keyed.join(small(indexed, row_bytes(5), broadcast_bytes), ["length", "block", "bits"]).where(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    # of a pair's equal blocks only the first goes on, so a pair is verified once
    low = F.array_position(F.transform(F.arrays_zip(blocks(F.col("print"), radius).alias("x"), blocks(F.col("item_print"), radius).alias("y")),
                                       lambda z: z["x"]["bits"] == z["y"]["bits"]), F.lit(True)) - 1
    near = near.where(F.col("block") == low)
    texts = small(items.select("item", "item_id", "item_parts"), F.length(F.array_join("item_parts", "")) + 16 * F.size("item_parts") + row_bytes(3), broadcast_bytes)
    told = near.join(texts, "item").withColumn("similarity", weighted_similarity(F.col("parts"), F.col("item_parts"))).where(F.col("similarity") >= similarity)
    best = told.groupBy("doc_id", TEXT_HASH, "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("neg"), "n_words")).alias("best"))
    return best.select("doc_id", TEXT_HASH, "item_id", F.col("best.similarity").alias("similarity"),
                       (-F.col("best.neg")).alias("start"), F.col("best.n_words").alias("n_words"))


def without_leaks(df: DataFrame, benchmark: DataFrame, row_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that hold no benchmark item; columns unchanged.  Edge cases as in
    ``leaks``: rows without an id are judged by their text."""
    found = leaks(df, benchmark, row_id, text, **options)
    own, own_hash = fresh(df.columns, "doc"), fresh(df.columns, "hash")
    marked = checkpointed(found.select(F.col("doc_id").alias(own), F.col(TEXT_HASH).alias(own_hash)).distinct())
    return df.join(small(marked, row_bytes(2), options.get("broadcast_bytes", BROADCAST_BYTES)), ref(row_id).cast("long").eqNullSafe(F.col(own))
                   & (F.xxhash64(F.coalesce(ref(text), F.lit(""))) == F.col(own_hash)), "left_anti")
