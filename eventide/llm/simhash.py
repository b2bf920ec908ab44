"""SimHash near-duplicates with BK-trees.

Every document gets a 64-bit SimHash of its word shingles.  Equal fingerprints
are one class at once (a grouping with partial aggregation), so a huge group of
copies is one fingerprint from here on.

Fingerprints are dealt to shards so that any two within the radius share one: of
the radius + 2 blocks of bits at least two are equal, so each fingerprint goes to
one shard per pair of blocks, keyed by their bits.  A shard's BK-tree holds its
fingerprints: a node's children are keyed by their integer Hamming distance to
it, and a search follows only edges within the radius of its own distance.  The
trees are not broadcast: all trees together are as large as the fingerprints of
the corpus, which has no bound; dealing both sides to the shard's task does the
same search.  A shard tells a star (member, smallest member) per group it finds
instead of all pairs, which loses no connection.  The stars' connected
components give each document the smallest reachable id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from eventide.llm.common import checkpointed, fresh, ref
from eventide.llm.components import smallest_reachable

SHINGLE, RADIUS, HASH_SEED = 3, 2, 42
CHUNK = 1 << 16
#: A fingerprint with more than this part of all rows is hot.
HOT_PARTS = 1000


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; of all words if they are fewer."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[:-size] if len(words) > size else [])]
    ends = (ends[size - 1:] if len(words) >= size else ends[-1:]) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s:e], HASH_SEED) for s, e in zip(starts, ends.tolist(), strict=True)], np.uint64)


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 without words.  As a
    signed 64-bit number."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


class BKTree:
    """Search tree of integers by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Number of the value's node, a new one unless it is there."""
        at, new = 0, len(self.values)
        while self.values:
            if not (d := (self.values[at] ^ value).bit_count()):
                return at
            if (child := self.children[at].setdefault(d, new)) == new:
                break
            at = child
        self.values.append(value)
        self.children.append({})
        return new

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            stack += [c for k, c in self.children[at].items() if d - radius <= k <= d + radius]


def stars(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) of each group of distinct values linked within
    the radius, without the smallest itself."""
    tree, parent = BKTree(), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, v in enumerate(sorted(values)):  # node i has the i-th smallest value
        parent.append(i)
        for j in tree.within(v, radius):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
        tree.add(v)
    return [(v, tree.values[root(i)]) for i, v in enumerate(tree.values) if root(i) != i]


def block_pair_masks(radius: int) -> list[int]:
    """Masks (signed) of each pair of the radius + 2 blocks of 64 bits."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [(m := a | b) - (1 << 64 if m >> 63 else 0) for a, b in combinations(blocks, 2)]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (fp): distinct fingerprints; result (a, b): stars of the shards."""
    keyed = F.explode(F.array(*[F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                                for i, m in enumerate(block_pair_masks(radius))])).alias("key")
    dealt = prints.select("fp", keyed).select("key.pair", "key.bits", "fp")
    dealt = dealt.repartition("pair", "bits").sortWithinPartitions("pair", "bits")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # the last shard so far may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            pair, bits = batch["pair"].to_numpy(), batch["bits"].to_numpy()
            cuts = np.flatnonzero((np.diff(pair) != 0) | (np.diff(bits) != 0)) + 1
            ends = bool(rest) and (rest[-1]["pair"].iloc[-1], rest[-1]["bits"].iloc[-1]) != (pair[0], bits[0])
            if not ends and not len(cuts):  # one shard goes on through the whole batch
                rest.append(batch)
                continue
            held, begun = sum(map(len, rest)), int(cuts[-1]) if len(cuts) else 0
            whole = np.concatenate([*[r["fp"].to_numpy() for r in rest], batch["fp"].to_numpy()[:begun]])
            yield told(whole, np.append([held] if ends else [], held + cuts).astype(np.int64))
            rest = [batch.iloc[begun:]]
        if rest:
            last = np.concatenate([r["fp"].to_numpy() for r in rest])
            yield told(last, np.array([len(last)]))

    def told(fp: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
        begins = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
        found = [x for s, e in zip(begins.tolist(), cuts.tolist(), strict=True) if e - s > 1
                 for x in stars([v & (1 << 64) - 1 for v in fp[s:e].tolist()], radius)]
        return pd.DataFrame(np.array(found, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return dealt.mapInPandas(search, "a long, b long").distinct()


def near_duplicates(df: DataFrame, row_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``fp`` (signed fingerprint), ``root`` (a
    fingerprint that stands for the component) and ``component_id``, the smallest
    id reachable over links of at most ``radius`` differing bits.

    Null texts have no words: fingerprint zero, linked like any other.  Rows
    without an id belong to components but never name one (null if nothing else is
    reachable).  Repeated rows are linked at distance 0.  An empty table gives an
    empty result.
    """
    @F.pandas_udf(LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    filled = F.coalesce(ref(text), F.lit(""))
    rows = checkpointed(df.select(ref(row_id).alias("doc_id"), F.xxhash64(filled).alias("text_hash"), hashed(filled).alias("fp")))
    classes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = checkpointed(smallest_reachable(links(classes.select("fp"), radius)))
    # only linked classes are joined: each with its root, the roots with themselves
    linked = roots.select("node", "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    members = classes.join(linked.withColumnRenamed("node", "fp"), "fp")
    named = members.groupBy("root").agg(F.min("least").alias("name"))
    placed = linked.join(named, "root").select(F.col("node").alias("fp"), "root", "name")
    final = classes.join(placed, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("name")).otherwise(F.col("least")).alias("component_id"), "n")
    # rows of a fingerprint that many share would meet in one task: those fingerprints,
    # at most HOT_PARTS in number, are broadcast and the others shuffled
    hot = F.broadcast(final.where(F.col("n") * HOT_PARTS > rows.count()).drop("n"))
    spread = rows.join(hot, "fp").unionByName(rows.join(hot.select("fp"), "fp", "left_anti").join(final.drop("n"), "fp"))
    return spread.select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(df: DataFrame, row_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """One row per component, the one with the smallest id; columns unchanged.

    Of rows that share that id the one with the smallest hash of its text stays, of
    equal ones the one with the smallest hash of its other columns.  A component
    without any id keeps one row in the same way.  An empty table stays empty.
    """
    found = near_duplicates(df, row_id, text, size, radius)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = found.groupBy("root").agg(F.min(first).alias("first"))
    own, own_hash, rank = (fresh(df.columns, n) for n in ("id", "hash", "rank"))
    kept = kept.select(F.col("first.doc_id").alias(own), F.col("first.text_hash").alias(own_hash))
    text_hash = F.xxhash64(F.coalesce(ref(text), F.lit("")))
    rows = df.join(kept, ref(row_id).eqNullSafe(F.col(own)) & (text_hash == F.col(own_hash)))
    others = [ref(c) for c, kind in df.dtypes if c not in (row_id, text) and "map<" not in kind and "variant" not in kind]
    order = F.xxhash64(*others) if others else F.lit(0)
    numbered = rows.withColumn(rank, F.row_number().over(Window.partitionBy(F.col(own), F.col(own_hash)).orderBy(order)))
    return numbered.where(F.col(rank) == 1).select(*map(ref, df.columns))
