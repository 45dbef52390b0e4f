"""Hard negatives by the threshold algorithm (Fagin, Lotem, Naor 2001) over integer vectors.

Rows are dealt into blocks, and every block keeps one list per dimension, its
rows sorted by that component. An anchor walks all lists together, each from
the end that its component's sign makes the better one. Rows met for the first
time are scored at once by random access to their whole vectors. The components
at which the lists stand bound every row not yet met; the walk stops when that
threshold is strictly below the kth score of what is sought (a tie could still
have a smaller id) or below the lower end of its window.

Positives are sought in blocks of the anchor's own label, then negatives in
blocks of all rows. Anchors come to a block as a stream after its rows, so a
task holds one block and one batch of anchors. The blocks' best rows are
merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored

#: Positives of an anchor, and negatives of a pair.
POSITIVES, NEGATIVES = 5, 3
#: Integer steps in a component of 1.
SCALE = 256
#: Largest integer component: keeps sums of products of 2,048 dimensions inside 64 bits.
MOST = 1 << 26
#: Rows of a block: between these, and by the root of the number of rows, so that neither the blocks (each is
#: visited by every anchor) nor their size grow in proportion to the table until blocks are as large as a task may hold.
LEAST_BLOCK, LARGEST_BLOCK, BLOCK_FACTOR = 4096, 65536, 16
#: Places of each list taken in the first step; later steps double the depth.
FIRST_STEP = 32


def block_rows(n: int) -> int:
    return min(LARGEST_BLOCK, max(LEAST_BLOCK, math.ceil(BLOCK_FACTOR * math.sqrt(n))))


def _best(best: np.ndarray, score: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` of two sets of rows: higher scores first, then smaller row numbers."""
    rows, scores = np.concatenate((best, rows)), np.concatenate((score, scores))
    if len(rows) > 4 * k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[near], scores[near]
    first = np.lexsort((rows, -scores))[:k]
    return rows[first], scores[first]


class SortedLists:
    """Rows of a block in id order, and their order in every dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.x = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.sort(vectors, axis=0).T
        self.largest = int(np.abs(vectors).max(initial=0))
        self.doubles = vectors.astype(np.float64) if self.largest < 1 << 26 else None

    def scores(self, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact integer products: through doubles where no sum can leave their whole numbers."""
        if self.doubles is not None and self.largest * int(np.abs(a).sum()) < 1 << 53:
            return (self.doubles[rows] @ a.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ a

    def walk(self, a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Steps of the walk: rows met first in it, their scores, and what no unmet row exceeds (None: all are met)."""
        n = len(self.ids)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        met, depth, end = np.zeros(n, bool), 0, min(n, FIRST_STEP)
        if not len(up) and not len(down):
            yield np.arange(n), np.zeros(n, np.int64), None
            return
        while True:
            before = met.copy()
            met[self.order[up, n - end:n - depth]] = True
            met[self.order[down, depth:end]] = True
            rows = np.flatnonzero(met > before)
            if met.all():
                yield rows, self.scores(rows, a), None
                return
            yield rows, self.scores(rows, a), int(self.values[up, n - end] @ a[up] + self.values[down, end - 1] @ a[down])
            depth, end = end, min(n, 2 * end)

    def positives(self, a: np.ndarray, own: int, k: int = POSITIVES) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows with another id."""
        best, score = np.empty(0, np.int64), np.empty(0, np.int64)
        for rows, scores, bound in self.walk(a):
            fresh = self.ids[rows] != own
            if len(best) == k:
                fresh &= scores >= score[-1]
            best, score = _best(best, score, rows[fresh], scores[fresh], k)
            if bound is None or len(best) == k and bound < score[-1]:
                break
        return self.ids[best], score

    def negatives(self, a: np.ndarray, allowed: np.ndarray, positive: np.ndarray, k: int = NEGATIVES):
        """For every positive score p, ids and scores of the best ``k`` allowed rows with 50 p <= 100 score <= 95 p."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in positive]
        todo = [i for i, p in enumerate(positive.tolist()) if p >= 0]  # below 0 the window is empty
        for rows, scores, bound in self.walk(a):
            if not todo:
                break
            some = allowed[rows] & (2 * scores >= positive[todo].min())
            rows, scores = rows[some], scores[some]
            left = []
            for i in todo:
                p = int(positive[i])
                best, score = found[i]
                hit = (20 * scores <= 19 * p) & (scores >= score[-1] if len(score) == k else 2 * scores >= p)
                if hit.any():
                    best, score = found[i] = _best(best, score, rows[hit], scores[hit], k)
                if bound is not None and 2 * bound >= p and not (len(score) == k and bound < score[-1]):
                    left.append(i)
            todo = left
        return [(self.ids[best], score) for best, score in found]


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with 0."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str], blocks: int, found: Callable, schema: str) -> DataFrame:
    """``found(lists, labels, anchor id, label, vector, positives' ids, their scores)`` gives result rows, for every anchor and
    block that share ``keys``. Rows: ``id, label, v``; anchors also ``p_id, p_score``."""
    none = F.array().cast("array<bigint>")
    columns = ["kind", "id", "label", "v", "p_id", "p_score"]
    both = rows.withColumns({"kind": F.lit(0), "p_id": none, "p_score": none}).select(*keys, *columns).unionByName(
        anchors.withColumn("kind", F.lit(1)).select(*keys, *columns))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, lists, labels = None, [], None, None
        for batch in batches:
            at = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys)))))
            kind, ids, label = (batch.column(len(keys) + i).to_numpy() for i in range(3))
            vectors = _matrix(batch.column(len(keys) + 3))
            p_id, p_score = (batch.column(len(keys) + i).to_pylist() for i in (4, 5))
            cuts = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1] or kind[i] != kind[i - 1]), len(at)]
            out: list[tuple] = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                if at[lo] != key:
                    key, parts, lists = at[lo], [], None
                if kind[lo] == 0:
                    parts.append((ids[lo:hi], label[lo:hi], vectors[lo:hi]))
                    continue
                if not parts:
                    continue  # a block without rows
                if lists is None or vectors.shape[1] > lists.x.shape[1]:
                    width = max(vectors.shape[1], *(p[2].shape[1] for p in parts))
                    x = np.concatenate([np.pad(p[2], ((0, 0), (0, width - p[2].shape[1]))) for p in parts])
                    labels = np.concatenate([p[1] for p in parts])
                    lists = SortedLists(np.concatenate([p[0] for p in parts]), x)
                for i in range(lo, hi):
                    a = np.zeros(lists.x.shape[1], np.int64)
                    a[:vectors.shape[1]] = vectors[i]
                    out.extend(found(lists, labels, int(ids[i]), int(label[i]), a, p_id[i], p_score[i]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(names))], names=names)

    return both.repartition(2 * blocks, *keys).sortWithinPartitions(*keys, "kind", "id").mapInArrow(run, schema)


def integer_vectors(df: DataFrame, id_col: str = "vec_id", label: Column | str = "label", vector_col: str = "embedding") -> DataFrame:
    """``id, label, v`` of the rows that take part, once per id."""
    scaled = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("bigint")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
                     F.col(vector_col).alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
    rows = rows.select("id", F.struct("label", F.transform("x", scaled).alias("v")).alias("r"))
    return rows.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")


def hard_negatives(df: DataFrame, anchors: str = "vec_id % 50 = 0", label: Column | str = "label", id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """The hardest negatives of every anchor and each of its positives.

    A row's vector is ``floor(256 * x)`` of its components; its score is the
    integer inner product with the anchor's. Higher scores come first, ties by
    smaller id. An anchor's positives are its first 5 other rows of its label
    (all, if fewer). For each, the first 3 (all, if fewer) rows of other labels with
    ``50 * positive_score <= 100 * score <= 95 * positive_score`` are returned:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    ``anchors`` is a condition on ``id_col``.

    Rows without an id, label or vector, or with a null or non-finite component, take no part. Rows that
    share an id count as the one with the smallest label, then vector. Shorter vectors count as filled
    with 0; integer components beyond +-2^26 as that. An empty table, or anchors without positives, give
    no rows. Other columns are not read. Ties and groups of equal vectors are walked through in full. All
    rows are searched for all anchors: the work is their product, as the question is.
    """
    ship_code()
    rows = stored(integer_vectors(df, id_col, label, vector_col), "vectors")
    chosen = rows.withColumnRenamed("id", id_col).where(anchors).withColumnRenamed(id_col, "id")
    n = rows.count()
    size = block_rows(n)
    none = F.array().cast("array<bigint>")

    def positives(lists, labels, own, label, a, p_id, p_score):
        ids, scores = lists.positives(a, own)
        return [(own, i, s) for i, s in zip(ids.tolist(), scores.tolist())]

    in_label = rows.groupBy("label").agg(F.ceil(F.count("*") / size).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    by_label = rows.join(in_label, "label").withColumn("part", part).drop("parts")
    to_label = chosen.join(in_label, "label").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    blocks = math.ceil(n / size) or 1
    best = _meet(by_label.withColumn("of", F.col("label")), to_label.withColumns({"of": F.col("label"), "p_id": none, "p_score": none}),
                 ["of", "part"], blocks, positives, "id bigint, p_id bigint, p_score bigint")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.col("p_score").desc(), "p_id"))
    best = best.withColumn("r", rank).where(F.col("r") <= POSITIVES).groupBy("id").agg(
        F.collect_list("p_id").alias("p_id"), F.collect_list("p_score").alias("p_score"))  # five at most
    paired = stored(chosen.join(best, "id"), "positives")

    def negatives(lists, labels, own, label, a, p_id, p_score):
        scores = np.array(p_score, np.int64)
        for i, s, (ids, found) in zip(p_id, p_score, lists.negatives(a, labels != label, scores)):
            yield from ((own, i, s, x, y) for x, y in zip(ids.tolist(), found.tolist()))

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    visiting = paired.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    met = _meet(dealt, visiting, ["part"], blocks, negatives,
                "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return met.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
