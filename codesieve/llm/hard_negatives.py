"""Hard-negative mining by a secondary sort: (anchor, descending score, id) keys and a streaming iterator.

Each component x becomes the integer floor(256 x); a row's score is its integer inner product with the anchor. An anchor's
positives are its first rows of the same label; each opens a window of scores between `low` and `high` per cent of its own,
and the first rows of another label inside the window are its hard negatives.

Anchors (the stated query set) meet all rows in blocks of ANCHORS, which are broadcast one after the other. Two passes
prune before the shuffle without losing a result: a task keeps, per anchor, its own first rows of the same label, and
with the positives known, per window its own first rows of another label; the first rows of all tasks are among those.
What is left is packed into keys (anchor, descending score, kind, id), dealt by anchor and sorted inside each partition
(repartition + sortWithinPartitions, the DataFrame form of repartitionAndSortWithinPartitions). An iterator then reads
the sorted keys once: a positive opens its window, a negative goes to every open window that holds its score, and a
window closes when it is full. It holds the open windows of one anchor, never the anchor's rows, so no group has to fit in
memory, and equal vectors that fill a third of the table cost a task `positives` and `negatives` rows an anchor.

Rows without id, label or vector, and vectors with null or non-finite components or of another length than most (ties: the
shorter), take no part. Rows that repeat an id count once (the smallest by label, then vector). Components
beyond +-sqrt(2^60 / length) count as that bound, so that scores stay within long. Other columns are left out, so
names cannot clash. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import stored
from codesieve.llm.vector_codes import whole_numbers

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
ANCHORS = 8192
TILE, ROWS = 512, 2048
PAIR = "anchor_id long, score long, negative boolean, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a x b' of integers: by floats as long as all sums are whole in them."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class FirstRows:
    """Per group its first k rows by descending score, then id, of the rows seen so far."""

    def __init__(self, groups: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.least = np.full(groups, np.iinfo(np.int64).min) if least is None else least.copy()
        self.rows = [np.empty(0, np.int64)] * 3  # group, score, id

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = (np.concatenate([old, new]) for old, new in zip(self.rows, (group, score, ids), strict=True))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.r_[True, group[1:] != group[:-1]]
        rank = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        keep = rank < self.k
        full = rank == self.k - 1
        self.least[group[full]] = score[full]  # a lower score can no longer enter; an equal one may, by its id
        self.rows = [group[keep], score[keep], ids[keep]]


def _blocks(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, list, np.ndarray]]:
    """(ids, labels, vectors) of at most ROWS rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            v = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)
            yield part.column("vec_id").to_numpy(), part.column("label").to_pylist(), v


def _same(labels: list, anchor_labels: list) -> np.ndarray:
    codes = {x: i for i, x in enumerate(dict.fromkeys([*labels, *anchor_labels]))}
    return np.array([codes[x] for x in anchor_labels])[:, None] == np.array([codes[x] for x in labels])[None, :]


def _pairs(first: FirstRows, anchor_ids: np.ndarray, negative: bool) -> pa.RecordBatch:
    group, score, ids = first.rows
    columns = [pa.array(anchor_ids[group]), pa.array(score), pa.array(np.full(len(group), negative)), pa.array(ids)]
    return pa.RecordBatch.from_arrays(columns, ["anchor_id", "score", "negative", "id"])


def _best_positives(rows: DataFrame, anchors: pa.Table, length: int, k: int) -> DataFrame:
    """Per task and anchor its first k other rows of the anchor's label, as pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(_unpacked(anchors, length))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, a_labels, a = shared.value
        first = FirstRows(len(a_ids), k)
        for ids, labels, v in _blocks(batches, length):
            for at in range(0, len(a), TILE):
                scores = inner_products(a[at : at + TILE], v)
                mine = _same(labels, a_labels[at : at + TILE]) & (a_ids[at : at + TILE, None] != ids)
                group, row = np.nonzero(mine & (scores >= first.least[at : at + TILE, None]))
                first.add(group + at, scores[group, row], ids[row])
        yield _pairs(first, a_ids, False)

    return rows.mapInArrow(scan, PAIR)


def _best_negatives(rows: DataFrame, anchors: pa.Table, positives: pa.Table, length: int, k: int, low: int, high: int) -> DataFrame:
    """Per task and window of a positive its first k rows of another label, as pairs (one per anchor and row)."""
    a_ids, a_labels, a = _unpacked(anchors, length)
    place = {x: i for i, x in enumerate(a_ids.tolist())}
    owner = [place[x] for x in positives.column("anchor_id").to_pylist()]
    scores = positives.column("score").to_pylist()
    # Exact bounds by whole numbers: low * positive <= 100 * negative <= high * positive.
    windows = sorted({(o, -(-low * s // 100), high * s // 100) for o, s in zip(owner, scores, strict=True) if -(-low * s // 100) <= high * s // 100})
    owner, least, most = (np.array([w[i] for w in windows], np.int64) for i in range(3))
    shared = rows.sparkSession.sparkContext.broadcast((a_ids, a_labels, a, owner, least, most))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, a_labels, a, owner, least, most = shared.value
        first = FirstRows(len(owner), k, least)
        for ids, labels, v in _blocks(batches, length):
            for at in range(0, len(a), TILE):
                scores = inner_products(a[at : at + TILE], v)
                other = ~_same(labels, a_labels[at : at + TILE])
                window = np.arange(*np.searchsorted(owner, [at, at + TILE]))
                for start in range(0, len(window), TILE):
                    some = window[start : start + TILE]
                    own = scores[owner[some] - at]
                    group, row = np.nonzero(other[owner[some] - at] & (own <= most[some, None]) & (own >= first.least[some, None]))
                    first.add(some[group], own[group, row], ids[row])
        group, score, ids = first.rows
        kept = pd.DataFrame({"group": owner[group], "score": score, "id": ids}).drop_duplicates()
        first.rows = [kept[c].to_numpy() for c in ("group", "score", "id")]
        yield _pairs(first, a_ids, True)

    return rows.mapInArrow(scan, PAIR)


def _unpacked(anchors: pa.Table, length: int) -> tuple[np.ndarray, list, np.ndarray]:
    ids = anchors.column("vec_id").to_numpy()
    v = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in anchors.column("v").chunks])
    return ids, anchors.column("label").to_pylist(), v.astype(np.int64).reshape(-1, length)


def _sorted_by_anchor(pairs: DataFrame) -> DataFrame:
    """The secondary sort: an anchor's pairs in one partition, highest score first, positives before equal negatives, then id."""
    return pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "negative", "id")


def stream_positives(batches: Iterable[pd.DataFrame], k: int = POSITIVES) -> Iterator[pd.DataFrame]:
    """The first k pairs of each anchor of sorted pairs."""
    anchor, seen = None, 0
    for batch in batches:
        keep = np.zeros(len(batch), bool)
        for i, a in enumerate(batch["anchor_id"].to_numpy()):
            if a != anchor:
                anchor, seen = a, 0
            keep[i] = seen < k
            seen += 1
        yield batch[keep]


def stream_negatives(batches: Iterable[pd.DataFrame], k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> Iterator[pd.DataFrame]:
    """Rows of RESULT from sorted pairs; memory holds one anchor's open windows and one batch.

    A negative found by several tasks or windows comes as equal neighbours, of which the first counts.
    """
    anchor, windows, last = None, [], None
    for batch in batches:
        out = []
        for a, score, negative, i in batch[["anchor_id", "score", "negative", "id"]].itertuples(index=False):
            if a != anchor:
                anchor, windows, last = a, [], None
            if not negative:
                windows.append([i, int(score), 0])
                continue
            if last == i:
                continue
            last = i
            for window in windows:
                positive, top, n = window
                if n < k and low * top <= 100 * int(score) <= high * top:
                    window[2] += 1
                    out.append((a, positive, n + 1, i, top, score))
        yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = ANCHORS) -> DataFrame:
    """RESULT: for each anchor and each of its positives the first hard negatives.

    rows has vec_id, label and embedding; is_anchor is a condition on them. `block` bounds the anchors that are broadcast at once.
    """
    spark = rows.sparkSession
    numbers, length = whole_numbers(rows.where("vec_id is not null and label is not null").withColumn("vec_id", F.col("vec_id").cast("long")), 1)
    once = numbers.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    once = stored(once)
    anchors = once.where(is_anchor)
    n_blocks = -(-anchors.count() // block)
    found = []
    for i in range(n_blocks):
        asked = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == i).toArrow()
        if not asked.num_rows:
            continue
        near = _sorted_by_anchor(_best_positives(once, asked, length, positives))
        near = stored(near.mapInPandas(lambda batches: stream_positives(batches, positives), PAIR))
        far = _best_negatives(once, asked, near.select("anchor_id", "score").toArrow(), length, negatives, low, high)
        found.append(stored(near.unionByName(far)))
    if not found:
        return spark.createDataFrame([], RESULT)
    pairs = _sorted_by_anchor(reduce(DataFrame.unionByName, found))
    return pairs.mapInPandas(lambda batches: stream_negatives(batches, negatives, low, high), RESULT)
