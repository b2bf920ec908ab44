"""Hard negatives by best-first search of cover trees.

For an anchor and one of its positives (its best rows of the same label) the hard
negatives are the best rows of other labels whose score lies in a window below the
positive's.  A score is the exact inner product of integer vectors.

1. *Trees.*  Every task cuts the rows that it reads into shards and builds a cover
   tree of each.  A row x is augmented with sqrt(M^2 - |x|^2), M the shard's largest
   norm, so that all rows lie on one sphere and inner products with an anchor (whose
   extra entry is 0) order them like angles.  A node's children are a net of its rows:
   further apart than the next level's radius, which covers them; every node keeps the
   largest angle from its centre to a row below.  Trees are written to the shared
   folder, one row each; nothing is shuffled.
2. *Search.*  With the angle t between an anchor and a centre and the radius r, the
   scores below a node lie within |q| M cos(t + r) and |q| M cos(t - r).  Nodes are opened
   best first; those that no window of the anchor can use any more, as they lie outside
   or below its worst kept score, are skipped; the rows of leaves are scored exactly.
   A task goes through its trees with what it has found so far, so it returns a few rows
   an anchor, and Spark picks the best of all tasks.
3. *Rounds.*  Anchors are the stated query set.  Equal ones are searched once.  They go
   in blocks of at most about ``ANCHORS``, the only rows that are broadcast; a round
   finds the positives of its block, then their negatives, and writes them.

All anchors meet all rows, so the work is their product less what the trees skip.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from eventide.llm.common import ref, shared_folder
from eventide.llm.vectors import usable

#: Rows of a tree at most, bytes of its vectors, and rows of a leaf.
SHARD, SHARD_BYTES, LEAF = 8192, 4 << 20, 32
#: A level's radius is that of the level above over BASE.
BASE = 1.3
#: Anchors of a block, on average at most.
ANCHORS = 1 << 15
#: Integer entries lie within this bound; larger ones are taken as the bound.
LARGEST = 1 << 24
NONE = np.iinfo(np.int64).min
#: Rounding of an angle, and of a bound relative to the largest score.
ANGLE, MARGIN = 1e-3, 1e-6


# ---------------------------------------------------------------- trees

class Tree(NamedTuple):
    """``points`` in the order of the leaves; node i has the rows first[i] .. last[i] - 1 if
    it is a leaf, else the children first[i] .. last[i] - 1."""

    name: str
    points: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaf: np.ndarray


FIELDS = {"points": np.int32, "ids": np.int64, "labels": np.int64, "centre": np.int32, "radius": np.float64,
          "first": np.int32, "last": np.int32, "leaf": np.bool_}
TREES = "tree string, length int, " + ", ".join(f"{f} binary" for f in FIELDS)


def on_sphere(points: np.ndarray) -> np.ndarray:
    """Unit vectors: the points with the entry that gives all of them the largest norm."""
    wide = points.astype(np.float64)
    squares = (wide * wide).sum(axis=1)
    top = squares.max(initial=0.0)
    out = np.column_stack([wide, np.sqrt(np.maximum(top - squares, 0.0))])
    return (out / np.sqrt(top) if top else out).astype(np.float32)


def angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1.0, 1.0)).astype(np.float64)


def net(unit: np.ndarray, rows: np.ndarray, centre: int, radius: float) -> Iterator[tuple[int, np.ndarray, float]]:
    """(centre, rows, largest angle) of the children: each takes the rows within the radius
    that are left, the node's own centre first."""
    while len(rows):
        away = angles(unit[rows], unit[centre])
        near = away <= radius
        near |= rows == centre
        yield centre, rows[near], float(away[near].max())
        rows = rows[~near]
        centre = int(rows[0]) if len(rows) else -1


def cover_tree(points: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf_rows: int = LEAF) -> Tree:
    unit = on_sphere(points)
    every = np.arange(len(points))
    radius = float(angles(unit, unit[0]).max())
    nodes = [(0, every, radius, radius)]  # centre, rows, covering radius, level's radius
    first, last, leaf, order, placed = [], [], [], [], 0
    for i, (centre, rows, covering, level) in enumerate(nodes):  # grows: breadth first
        while level > ANGLE and level >= covering:  # levels on which the node would be its only child
            level /= BASE
        if len(rows) <= leaf_rows or covering <= ANGLE:
            first.append(placed)
            placed += len(rows)
            last.append(placed)
            order.append(rows)
        else:
            first.append(len(nodes))
            nodes += [(c, own, most, level) for c, own, most in net(unit, rows, centre, level)]
            last.append(len(nodes))
        leaf.append(len(rows) <= leaf_rows or covering <= ANGLE)
    by_leaf = np.concatenate(order)
    place = np.empty(len(points), np.int64)
    place[by_leaf] = every
    return Tree(uuid.uuid4().hex, points[by_leaf].astype(np.int32), ids[by_leaf], labels[by_leaf],
                place[[n[0] for n in nodes]].astype(np.int32), np.array([n[2] for n in nodes]) + ANGLE,
                np.array(first, np.int32), np.array(last, np.int32), np.array(leaf))


def tree_rows(batches: Iterable[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Trees of the rows (id, label, vector) of a partition."""
    held: dict[int, list[tuple[np.ndarray, ...]]] = {}

    def built(length: int) -> pa.RecordBatch:
        points, ids, labels = (np.concatenate(x) for x in zip(*held.pop(length), strict=True))
        tree = cover_tree(points, ids, labels)
        return pa.RecordBatch.from_arrays(
            [pa.array([tree.name]), pa.array([length], pa.int32()), *[pa.array([getattr(tree, f).tobytes()], pa.binary()) for f in FIELDS]],
            ["tree", "length", *FIELDS])

    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        for rows, values in usable(batch.column(2)):
            length = values.shape[1]
            most = max(LEAF, min(SHARD, SHARD_BYTES // max(1, 4 * length)))
            x = np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int32)
            at = 0
            while at < len(rows):
                parts = held.setdefault(length, [])
                room = most - sum(len(p[1]) for p in parts)
                own = rows[at:at + room]
                parts.append((x[at:at + room], ids[own].astype(np.int64), labels[own].astype(np.int64)))
                at += room
                if len(own) == room:
                    yield built(length)
    for length in list(held):
        yield built(length)


def trees_in(batches: Iterable[pa.RecordBatch]) -> Iterator[Tree]:
    for batch in batches:
        for i in range(batch.num_rows):
            cell = {f: np.frombuffer(batch.column(f)[i].as_buffer(), kind) for f, kind in FIELDS.items()}
            cell["points"] = cell["points"].reshape(len(cell["ids"]), batch.column("length")[i].as_py())
            yield Tree(name=batch.column("tree")[i].as_py(), **cell)


# ---------------------------------------------------------------- search

class Anchors(NamedTuple):
    """A block of anchors of one length.  Anchor a has the windows first[a] .. first[a + 1] - 1,
    in which scores of ``low`` to ``high`` are sought."""

    vectors: np.ndarray
    labels: np.ndarray
    tree: np.ndarray  # names; the place in the tree of the anchor's own row
    place: np.ndarray
    first: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Found:
    """The best ``size`` (score, id) of each window so far."""

    def __init__(self, windows: int, size: int):
        self.scores = np.full((windows, size), NONE)
        self.ids = np.zeros((windows, size), np.int64)

    def add(self, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores[window], scores), np.append(self.ids[window], ids)
        best = np.lexsort((ids, -scores))
        size = self.scores.shape[1]
        # places without a score come last, whatever their id
        best = np.concatenate([best[scores[best] != NONE], best[scores[best] == NONE]])[:size]
        self.scores[window], self.ids[window] = scores[best], ids[best]


def exact_type(largest: float) -> type:
    """The fastest type in which inner products below ``largest`` come out exactly: all
    partial sums are integers below it too (Cauchy-Schwarz)."""
    return np.float32 if largest < 1 << 23 else np.float64 if largest < 1 << 52 else np.int64


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0] .. last[0] - 1, first[1] .. last[1] - 1, ..."""
    sizes = last - first
    return np.repeat(first - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())


def search(tree: Tree, anchors: Anchors, found: Found, same_label: bool) -> None:
    """Add the tree's rows to ``found``: for each anchor rows of its label (but itself), or of others."""
    squares = np.sqrt((tree.points.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
    norms = np.sqrt((anchors.vectors.astype(np.float64) ** 2).sum(axis=1))
    kind = exact_type(squares * norms.max(initial=0.0))
    points, vectors = tree.points.astype(kind), anchors.vectors.astype(kind)
    centres = points[tree.centre]
    for a in range(len(vectors)):
        s, e = anchors.first[a], anchors.first[a + 1]
        if s == e:
            continue
        low, high, q = anchors.low[s:e], anchors.high[s:e], vectors[a]
        itself = anchors.place[a] if same_label and anchors.tree[a] == tree.name else -1
        most = squares * norms[a]
        nodes, upper, lower = np.zeros(1, np.int64), np.full(1, np.inf), np.full(1, -np.inf)
        batch = 4
        while True:
            least = np.maximum(low, found.scores[s:e, -1])
            useful = ((upper[:, None] >= least) & (lower[:, None] <= high)).any(axis=1)
            nodes, upper, lower = nodes[useful], upper[useful], lower[useful]
            if not len(nodes):
                break
            if len(nodes) > batch:  # open the best, keep the others
                best = np.argpartition(-upper, batch - 1)
                opened, rest = nodes[best[:batch]], best[batch:]
                nodes, upper, lower = nodes[rest], upper[rest], lower[rest]
            else:
                opened, nodes, upper, lower = nodes, nodes[:0], upper[:0], lower[:0]
            batch *= 2
            is_leaf = tree.leaf[opened]
            inner, leaves = opened[~is_leaf], opened[is_leaf]
            if len(inner):
                children = ranges(tree.first[inner], tree.last[inner])
                away = np.arccos(np.clip((centres[children] @ q) / most, -1.0, 1.0)) if most else np.zeros(len(children))
                r, slack = tree.radius[children], MARGIN * most + 1
                nodes = np.concatenate([nodes, children])
                upper = np.concatenate([upper, most * np.cos(np.maximum(away - r, 0.0)) + slack])
                lower = np.concatenate([lower, most * np.cos(np.minimum(away + r, np.pi)) - slack])
            if len(leaves):
                rows = ranges(tree.first[leaves], tree.last[leaves])
                fits = (tree.labels[rows] == anchors.labels[a]) == same_label
                if itself >= 0:
                    fits &= rows != itself
                rows = rows[fits]
                scores = (points[rows] @ q).astype(np.int64)
                for w in range(s, e):
                    kept = (scores >= max(anchors.low[w], found.scores[w, -1])) & (scores <= anchors.high[w])
                    if kept.any():
                        found.add(w, scores[kept], tree.ids[rows[kept]])


HITS = "win long, score long, id long"


def searched(trees: DataFrame, blocks: dict[int, Anchors], size: int, same_label: bool) -> DataFrame:
    """(win, score, id): the best ``size`` of each window in each task's trees; windows
    are numbered through the lengths in order."""
    shared = trees.sparkSession.sparkContext.broadcast(blocks)

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {length: Found(len(b.low), size) for length, b in shared.value.items()}
        for tree in trees_in(batches):
            if (length := tree.points.shape[1]) in found:
                search(tree, shared.value[length], found[length], same_label)
        at = 0
        for f in found.values():
            window, k = np.nonzero(f.scores != NONE)
            yield pa.RecordBatch.from_arrays([pa.array(window + at), pa.array(f.scores[window, k]), pa.array(f.ids[window, k])],
                                             ["win", "score", "id"])
            at += len(f.scores)

    best = Window.partitionBy("win").orderBy(F.desc("score"), "id")
    hits = trees.mapInArrow(told, HITS).withColumn("rank", F.row_number().over(best))
    return hits.where(F.col("rank") <= size)


# ---------------------------------------------------------------- operator

def anchor_rows(batches: Iterable[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for tree in trees_in(batches):
        at = np.flatnonzero(tree.ids % every == 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([tree.name] * len(at), pa.string()), pa.array(at), pa.array(tree.ids[at]), pa.array(tree.labels[at]),
             pa.array([tree.points[i].tobytes() for i in at], pa.binary())], ["tree", "place", "id", "label", "vector"])


def hard_negatives(df: DataFrame, row_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0,
                   every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
                   anchors_at_once: int = ANCHORS) -> DataFrame:
    """Per anchor, positive and negative: ``anchor_id``, ``positive_id``, ``rank`` (from 1),
    ``negative_id``, ``positive_score``, ``negative_score``.

    Vectors are taken as integers floor(scale * x), within 2^24; anchors are the rows whose
    id ``every`` divides.  A positive is one of the best ``n_positives`` other rows of the
    anchor's label; its negatives are the best ``n_negatives`` rows of other labels with low
    * positive score <= 100 * score <= high * positive score.  Ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite entry, take no part; labels
    are integers.  Vectors of different lengths have no score with each other.  Repeated rows
    each count, as anchors (each with its result rows), positives and negatives.  A positive
    without negatives has no row; an empty table gives an empty result.  Extra columns,
    whatever their names, aren't read.
    """
    for c in (row_id, label):
        if not isinstance(df.schema[c].dataType, IntegralType):
            raise TypeError(f"{c} must be an integer column")
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    rows = df.select(ref(row_id).cast("long").alias("id"), ref(label).cast("long").alias("label"), ref(vector).alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows.mapInArrow(lambda b: tree_rows(b, scale), TREES).write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    own = trees.mapInArrow(lambda b: anchor_rows(b, every), "tree string, place long, id long, label long, vector binary")
    own = own.groupBy("id", "label", "vector").agg(F.min(F.struct("tree", "place")).alias("own"), F.count("*").alias("copies"))
    own.select("id", "label", "vector", "own.*", "copies").write.parquet(f"{folder}/anchors")
    anchors = spark.read.parquet(f"{folder}/anchors")
    blocks = -(-anchors.count() // anchors_at_once)
    schema = "anchor_id long, copies long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for b in range(blocks):
        block = anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == b).toPandas()
        mined(trees, block, n_positives, n_negatives, low, high).write.parquet(f"{folder}/mined/block={b}")
    if not blocks:
        return spark.createDataFrame([], schema).drop("copies")
    out = spark.read.schema(schema).parquet(*[f"{folder}/mined/block={b}" for b in range(blocks)])
    each = out.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))  # repeated anchors
    return each.drop("copy", "copies")


def mined(trees: DataFrame, block, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame:
    """A round: the negatives of a block of anchors (a pandas frame)."""
    spark = trees.sparkSession
    block = block.assign(length=block["vector"].map(len) // 4).sort_values("length", kind="stable").reset_index(drop=True)
    lengths = {n: g for n, g in block.groupby("length")}

    def blocks_of(count: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> dict[int, Anchors]:
        """The anchors with their windows, ``count`` for each, in order."""
        ends, out = np.append(0, np.cumsum(count)), {}
        for n, g in lengths.items():
            s, e = g.index[0], g.index[-1] + 1
            vectors = np.frombuffer(b"".join(g["vector"]), np.int32).reshape(len(g), n)
            out[int(n)] = Anchors(vectors, g["label"].to_numpy(), g["tree"].to_numpy(object), g["place"].to_numpy(),
                                  ends[s:e + 1] - ends[s], lows[ends[s]:ends[e]], highs[ends[s]:ends[e]])
        return out

    one = np.ones(len(block), np.int64)
    best = searched(trees, blocks_of(one, NONE + one, -(NONE + one)), n_positives, True).toPandas()
    best = best.sort_values(["win", "rank"]).reset_index(drop=True)
    score, own = best["score"].to_numpy(np.int64), best["win"].to_numpy(np.int64)
    lows, highs = -((-low * score) // 100), high * score // 100
    hits = searched(trees, blocks_of(np.bincount(own, minlength=len(block)), lows, highs), n_negatives, False)
    # windows are numbered like the positives: their part of the result is as small as the block
    names = best.assign(win=best.index, anchor_id=block["id"].to_numpy()[own], copies=block["copies"].to_numpy()[own])
    named = spark.createDataFrame(names[["win", "anchor_id", "copies", "id", "score"]].rename(
        columns={"id": "positive_id", "score": "positive_score"}), "win long, anchor_id long, copies long, positive_id long, positive_score long")
    return hits.join(F.broadcast(named), "win").select(
        "anchor_id", "copies", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
