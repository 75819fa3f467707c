"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded hash sample (`fit_rows` vectors, the bound is a parameter): k-means with
BRANCHES centres, again inside each cell, down to cells of about `leaf_rows` sampled vectors. Every vector of the
table is indexed: it descends to the leaf with the nearest centres.

A query visits leaves best bin first: a priority queue holds cells by the distance from the query to the cell's
centre; the nearest is opened, its children are pushed, and leaves come out in order of promise. How many
are visited is calibrated: for `calibrate` queries the true neighbours are found against all rows, the rank of
the leaf of each neighbour in its query's order is looked up, and the visits are widened until `target`
of the neighbours lie in visited leaves.

Vectors equal to each other always share a leaf, so only the smallest ids of each distinct vector are
searched (as many as could be among the nearest): a vector that fills a third of the table costs a few rows.
Leaves are cut into blocks of BLOCK rows, and each block meets the queries that visit its leaf as one matrix.

Distances are Euclidean in double precision on the original vectors; ties go to the smaller id. The tree works on
vectors shifted by their mean and scaled by a power of two, and candidates inside a block are chosen within the rounding error of centred products, so that
neither a common offset nor very large or small components cost a neighbour. Vectors that
are null, zero, of another length than most, or hold null or non-finite components take no part; neither do rows
without id. Rows that repeat id and vector count once. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.common import stored

NEAREST = 10
BRANCHES = 8
FIT_ROWS, LEAF_ROWS = 20_000, 60
CALIBRATE, TARGET = 200, 0.97
BLOCK = 4096


@dataclass
class Node:
    """A cell: the children's centres and the children, or a leaf number."""

    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


@dataclass
class Place:
    """Where the tree sees a vector: scaled by a power of two and shifted by the sample's mean."""

    scale: float
    middle: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x / self.scale - self.middle, -1e100, 1e100)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _squares(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(x: np.ndarray, leaf_rows: int = LEAF_ROWS, branches: int = BRANCHES, seed: int = 7) -> tuple[Node, int]:
    """(tree, number of leaves) of the sampled vectors."""
    rng = np.random.default_rng(seed)
    n_leaves = 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal n_leaves
        distinct = np.unique(rows, axis=0) if len(rows) > leaf_rows else rows
        if len(distinct) <= max(leaf_rows, branches):
            n_leaves += 1
            return Node(leaf=n_leaves - 1)
        centres = _kmeans(rows, branches, rng)
        own = _squares(rows, centres).argmin(1)
        used = np.unique(own)
        if len(used) == 1:
            n_leaves += 1
            return Node(leaf=n_leaves - 1)
        return Node(centres[used], [grow(rows[own == i]) for i in used])

    return grow(x), n_leaves


def leaves_of(tree: Node, x: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    out = np.zeros(len(x), np.int64)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.centres is None:
            out[rows] = node.leaf
        elif len(rows):
            own = _squares(x[rows], node.centres).argmin(1)
            todo += [(child, rows[own == i]) for i, child in enumerate(node.children)]
    return out


def best_bins(tree: Node, q: np.ndarray, most: int) -> list[int]:
    """The first `most` leaves in the order of the priority queue."""
    queue, out, tie = [(0.0, 0, tree)], [], 0
    while queue and len(out) < most:
        _, _, node = heapq.heappop(queue)
        if node.centres is None:
            out.append(node.leaf)
            continue
        for d, child in zip(((node.centres - q) ** 2).sum(1), node.children, strict=True):
            tie += 1
            heapq.heappush(queue, (float(d), tie, child))
    return out


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, v as array<double>."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False)))
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0)).dropDuplicates(["vec_id", "v"])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.empty((0, 0))


def _scale(*x: np.ndarray) -> float:
    """A power of two by which components are divided so that their squares neither overflow nor vanish; mostly 1."""
    most = max((float(np.abs(a).max(initial=0)) for a in x), default=0.0)
    return 1.0 if most == 0 or 1e-100 < most < 1e100 else 2.0 ** (math.frexp(most)[1] - 1)


def distances(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances by exact differences; the scale is a power of two, so it changes no digit."""
    s = _scale(x, v)
    return np.sqrt(((x / s - v / s) ** 2).sum(1)) * s


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """k nearest rows (vec_id, v) of each query (query_id, v), other than itself, by exact differences."""
    out = []
    x, ids, asked = _matrix(rows["v"]), rows["vec_id"].to_numpy(), _matrix(queries["v"])
    s = _scale(x, asked)
    middle = (x / s).mean(0)
    near_x, near_q = x / s - middle, asked / s - middle
    rough = _squares(near_q, near_x)
    # Rounding of the quick form: a few units in the last place of the squared lengths, summed over the components.
    slack = 8 * (x.shape[1] + 8) * np.finfo(float).eps * ((near_x**2).sum(1).max() + (near_q**2).sum(1))
    for q, v, near, error in zip(queries["query_id"], asked, rough, slack, strict=True):
        bound = np.partition(near, k)[k] if len(near) > k + 1 else np.inf
        own = np.flatnonzero(near <= bound + 2 * error)
        d = distances(x[own], v)
        keep = ids[own] != q
        own, d = own[keep], d[keep]
        order = np.lexsort((ids[own], d))[:k]
        out.append(pd.DataFrame({"query_id": q, "vec_id": ids[own[order]], "score": d[order]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(queries: DataFrame, rows: DataFrame, k: int = NEAREST) -> DataFrame:
    """Nearest rows by full comparison; queries (query_id, v) must be few, they go to every task."""
    frame = queries.toPandas()
    shared = rows.sparkSession.sparkContext.broadcast(frame)

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(shared.value) and len(batch):
                yield _nearest(shared.value, batch, k)

    return _best(rows.mapInPandas(scan, "query_id long, vec_id long, score double"), k)


def search(rows: DataFrame, is_query: Column, k: int = NEAREST, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF_ROWS, calibrate: int = CALIBRATE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which is_query holds, among all rows."""
    spark = rows.sparkSession
    every = stored(usable(rows))
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = stored(every.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy"))
    queries = every.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    empty = "query_id long, rank int, vec_id long, score double"
    sample = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).select("v").toPandas()
    if not len(sample):
        return spark.createDataFrame([], empty)
    x = _matrix(sample["v"])
    place = Place(_scale(x), (x / _scale(x)).mean(0))
    tree, n_leaves = fit(place.of(x), leaf_rows)
    shared = spark.sparkContext.broadcast((tree, place))

    def index(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                tree, place = shared.value
                yield batch.assign(leaf=leaves_of(tree, place.of(_matrix(batch["v"]))))

    indexed = stored(kept.mapInPandas(index, "vec_id long, v array<double>, leaf long"))
    visits = calibrated(indexed, queries, tree, place, n_leaves, k, calibrate, target)
    blocks = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))

    def bins(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tree, place = shared.value
            leaves = [best_bins(tree, place.of(np.asarray(v)), visits) for v in batch["v"]]
            yield batch.assign(leaf=leaves).explode("leaf").astype({"leaf": "int64"})

    asked = queries.mapInPandas(bins, "query_id long, v array<double>, leaf long").join(blocks, "leaf")
    parts = F.ceil(F.count("*").over(Window.partitionBy("leaf")) / BLOCK)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), parts)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    asked = stored(asked.select("query_id", "v", "leaf", "block", "part"))
    # Both sides of a leaf are dealt into blocks, so a task holds at most BLOCK rows and about BLOCK queries.
    dealt = indexed.join(blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).cast("int"))
    wanted = asked.select(*(F.col(c).alias(c) for c in ("leaf", "block", "part"))).distinct()
    dealt = dealt.join(wanted, ["leaf", "block"]).select("leaf", "block", "part", "vec_id", "v")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _nearest(left[["query_id", "v"]], right[["vec_id", "v"]], k)

    key = ["leaf", "block", "part"]
    found = asked.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double")
    return _best(found, k)


def calibrated(indexed: DataFrame, queries: DataFrame, tree: Node, place: Place, n_leaves: int, k: int, calibrate: int, target: float) -> int:
    """Leaves to visit so that `target` of the sampled queries' true neighbours are found."""
    sample = queries.orderBy(F.xxhash64("query_id", F.lit(3)), "query_id").limit(calibrate)
    truth = exact(sample, indexed.select("vec_id", "v"), k)
    leaves = truth.join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    vectors = dict(sample.toPandas().itertuples(index=False))
    ranks = []
    for q, own in leaves.groupby("query_id"):
        rank = {leaf: i for i, leaf in enumerate(best_bins(tree, place.of(np.asarray(vectors[q])), n_leaves), 1)}
        ranks += [rank[leaf] for leaf in own["leaf"]]
    visits = 1
    while visits < n_leaves and np.mean([r <= visits for r in ranks] or [1]) < target:
        visits = min(n_leaves, max(visits + 1, visits * 5 // 4))
    return visits
