"""N-gram Jaccard self-join by T-occurrence search (DivideSkip), and the classes its links make.

A document's set holds its distinct k-word shingles (words lower-cased A-Z; the whole sequence if it has
fewer words; nothing without words). Two documents link if 100 * intersection >= percent * union.

A set of n shingles shares at least T = ceil(percent / 100 * n) of them with any partner. Its shingles are
lists of documents in an inverted index. DivideSkip sets the T - k longest lists of a query apart: a partner
stands in at least k of the n - T + k short ones, which are merged by a heap that skips ids seen too rarely,
and then the long lists are probed by binary search until T is reached or out of reach; k is SHORT_SHARED, or T
where that is less, and for a pair the smaller of both. For this all sets are ordered alike: shingles by hash, but those that Spark counted most often (LONG_LISTS of them, from
counts over all texts; they steer cost, never results) last.

The steps, each a Spark job over rows that are dealt by shingle or by set:

1. Documents with equal sets become one node, named by a 64-bit digest of the set and its size.
2. Every node posts its short lists. Lists with one node end here.
3. Star round: each list's smallest node is the candidate of the list's other nodes; those found in k or more
   lists are verified. This ties large groups of near copies together with a pair per node instead of all pairs.
4. Search round: nodes of lists that still hold several components are placed in blocks of about BLOCK nodes
   that share lists. A node asks the blocks with which it shares k short lists; there the heap merge over the
   block's inverted index finds its candidates in other components, and the probes verify them. Links inside a
   component change nothing, so skipping them loses none, and pairs are never rows: a block returns only links
   that tie components.
5. Components of all links by alternating large and small stars, with written tables between rounds.

Nulls: a null text has an empty set; a null doc_id gets a null component and takes no part. Rows that
repeat an id belong to one document if equal; else the id links with what any of its rows links with.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import Steps

WORDS, PERCENT = 5, 80
LONG_LISTS = 200_000
LOCAL_REPEATS = 3
BLOCK = 256
SHORT_SHARED = 8
TEXT_CHUNK = 1 << 20
MARK_BITS = 1 << 26
# Rows of nodes and the blocks they meet, and bytes of sets, that one pass shuffles.
MET, SHIPPED = 1 << 26, 1 << 30


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)
    rolled = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for i in range(k):
        rolled = _mix(rolled + hashes[i : len(rolled) + i])
    starts = np.r_[0, np.cumsum(sizes)]
    out = []
    for at, n in zip(starts, sizes, strict=False):
        if n >= k:
            s = np.sort(rolled[at : at + n - k + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif n:
            one = np.array([n], np.uint64)
            for h in hashes[at : at + n]:
                one = _mix(one + h)
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def least_shared(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """T: shingles that a set of n shares with any partner, at least."""
    return -(-n * percent // 100)


def digest(s: np.ndarray) -> int:
    """Node name: sum of remixed hashes and the size; equal for equal sets."""
    with np.errstate(over="ignore"):
        total = _mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return int(_mix(np.array([total], np.uint64)).view(np.int64)[0])


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about TEXT_CHUNK characters, so that a worker holds the words of one slice at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // TEXT_CHUNK
        edges = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(part) else []
        for start, end in zip(edges, edges[1:], strict=False):
            yield batch.slice(start, end - start)


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def profiles(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents (doc_id, node, n) and, with a null doc_id, of shingles common in one slice (node, n = count)."""
    names = ["doc_id", "node", "n"]

    def profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = shingle_sets(part.column("text").to_pylist(), k)
            nodes, sizes = (np.array([f(s) for s in sets], np.int64) for f in (digest, len))
            yield _rows(names, part.column("doc_id"), nodes, sizes)
            seen, count = np.unique(np.concatenate(sets), return_counts=True)
            many = count >= LOCAL_REPEATS
            yield _rows(names, pa.nulls(int(many.sum()), pa.int64()), seen[many].view(np.int64), count[many].astype(np.int64))

    return docs.select("doc_id", "text").mapInArrow(profile, "doc_id long, node long, n long")


def _ordered(s: np.ndarray, long_lists: np.ndarray) -> np.ndarray:
    """A set in the common order: by hash, long lists last."""
    if not len(long_lists) or not len(s):
        return s
    at = np.minimum(np.searchsorted(long_lists, s), len(long_lists) - 1)
    long = long_lists[at] == s
    return np.r_[s[~long], s[long]]


def short_lists(docs: DataFrame, long_lists, k: int, percent: int) -> DataFrame:
    """(shingle, node, n): what each document posts."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = [s for s in shingle_sets(part.column("text").to_pylist(), k) if len(s) > 1]  # a set of one links with equal sets only
            least = [least_shared(len(s), percent) for s in sets]
            short = [_ordered(s, long_lists.value)[: len(s) - t + min(SHORT_SHARED, t)] for s, t in zip(sets, least, strict=True)]
            if sets:
                times = [len(s) for s in short]
                nodes, sizes = (np.repeat(np.array([f(s) for s in sets], np.int64), times) for f in (digest, len))
                yield _rows(["shingle", "node", "n"], np.concatenate(short).view(np.int64), nodes, sizes)

    return docs.where("doc_id is not null").select("text").mapInArrow(post, "shingle long, node long, n long")


def _fits(a: str, b: str, percent: int) -> str:
    """Length filter: sets of these sizes can reach the threshold."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _needed(n: str, percent: int) -> str:
    """k: short lists that a set of n shares with any partner at least."""
    return f"least({SHORT_SHARED}, ({n} * {percent} + 99) div 100)"


class Marks:
    """Some long ids as set bits of a table of at most MARK_BITS bits: has() is true for all of them and for few others."""

    def __init__(self, ids: DataFrame):
        (name,) = ids.columns
        bits = min(MARK_BITS, 1 << max(16, (16 * ids.count()).bit_length()))

        def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                at = _mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
            used = np.flatnonzero(own)
            yield _rows(["word", "bits"], used.astype(np.int64), own[used].view(np.int64))

        found = ids.where(F.col(name).isNotNull()).mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(bits // 64, np.uint64)
        table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.bits, self.table = bits, ids.sparkSession.sparkContext.broadcast(table)

    def has(self, ids: pa.Array) -> np.ndarray:
        there = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        at = _mix(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(self.bits - 1)
        return there & ((self.table.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not in gone (doc_id). Only rows that Marks cannot tell apart are joined, so texts are not shuffled."""
    marks = Marks(gone)

    @F.arrow_udf("boolean")
    def marked(ids: pa.Array) -> pa.Array:
        return pa.array(marks.has(ids))

    rows = docs.withColumn("_marked", marked(F.col("doc_id").cast("long")))
    return rows.where("not _marked").unionByName(rows.where("_marked").join(gone, "doc_id", "left_anti").select(*rows.columns)).drop("_marked")


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose column named as that of ids has a value of ids, and few others; nothing is shuffled."""
    (name,), marks = ids.columns, Marks(ids)

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marks.has(batch.column(name))))

    return rows.mapInArrow(chosen, rows.schema)


def node_sets(docs: DataFrame, nodes: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """(node, items): the sets of the nodes, sorted by hash, read again from each node's first document.

    Documents are chosen where they are read, by Marks, so no text is shuffled; a few sets come that nobody asked for.
    """

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            found = shingle_sets(part.column("text").to_pylist(), k)
            yield _rows(["node", "items"], np.array([digest(s) for s in found], np.int64), pa.array([s.tobytes() for s in found], pa.binary()))

    wanted = first.join(nodes, "node", "left_semi").select("doc_id")
    return among(docs.select("doc_id", "text"), wanted).select("text").mapInArrow(sets, "node long, items binary")


def merge_skip(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(id, lists that hold it) for ids in at least `least` of the sorted lists, by a heap of list heads.

    Where fewer than `least` heads are equal, the smaller heads jump by binary search to the smallest head
    that could still be found often enough.
    """
    heap = [(x[0], i) for i, x in enumerate(lists) if x]
    heapq.heapify(heap)
    at = [0] * len(lists)
    out = []
    while len(heap) >= least:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            out.append((top, len(popped)))
            target = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for i in popped:
            at[i] = bisect_left(lists[i], target, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))
    return out


def probe(query: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link: query's lists are probed in other by binary search, in blocks, until decided."""
    n, m = len(query), len(other)
    need = -(-percent * (n + m) // (100 + percent))
    shared, step = 0, 256
    for start in range(0, n, step):
        block = query[start : start + step]
        at = np.minimum(np.searchsorted(other, block), m - 1)
        shared += int((other[at] == block).sum())
        if shared >= need:
            return True
        if shared + n - start - len(block) < need:
            return False
    return shared >= need


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([probe(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right, strict=True)], dtype=bool)

    a = sets.select(F.col("node").alias("a"), F.col("items").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("right"))
    return pairs.join(a, "a").join(b, "b").where(linked("left", "right")).select("a", "b").distinct()


def _short(items: np.ndarray, long_lists: np.ndarray, percent: int) -> list[int]:
    """The shingles of a set's short lists."""
    t = least_shared(len(items), percent)
    return _ordered(items, long_lists)[: len(items) - t + min(SHORT_SHARED, t)].tolist()


class Lists:
    """One block of nodes with an inverted index of their short lists."""

    def __init__(self, percent: int):
        self.percent = percent
        self.nodes: list[int] = []
        self.parts: list[int] = []
        self.sizes: list[int] = []
        self.index: dict[int, list[int]] = {}

    def add(self, node: int, part: int, n: int, shingles: list[int]) -> None:
        for s in shingles:
            self.index.setdefault(s, []).append(len(self.nodes))
        self.nodes.append(node)
        self.parts.append(part)
        self.sizes.append(n)

    def candidates(self, node: int, part: int, n: int, shingles: list[int]) -> Iterator[int]:
        """Places of later nodes in other components that are found in enough of the lists and fit in size."""
        least = min(SHORT_SHARED, least_shared(least_shared(n, self.percent), self.percent))
        for i, _ in merge_skip([self.index[s] for s in shingles if s in self.index], least):
            m = self.sizes[i]
            if self.nodes[i] > node and self.parts[i] != part and 100 * min(n, m) >= self.percent * max(n, m):
                yield i


class Block(Lists):
    """A block with the sets of its nodes."""

    def __init__(self, long_lists: np.ndarray, percent: int):
        super().__init__(percent)
        self.long_lists = long_lists
        self.sets: list[np.ndarray] = []
        self.joined: dict[int, int] = {}  # components tied by links found here

    def place(self, node: int, part: int, items: np.ndarray) -> None:
        self.add(node, part, len(items), _short(items, self.long_lists, self.percent))
        self.sets.append(items)

    def _find(self, part: int) -> int:
        while (up := self.joined.get(part, part)) != part:
            part = up
        return part

    def links(self, node: int, part: int, items: np.ndarray) -> Iterator[int]:
        """Later nodes of the block, in components not tied to this one yet, that link with the given set."""
        for i in self.candidates(node, part, len(items), _short(items, self.long_lists, self.percent)):
            own, other = self._find(part), self._find(self.parts[i])
            if own != other and probe(items, self.sets[i], self.percent):
                self.joined[max(own, other)] = min(own, other)
                yield self.nodes[i]


def _placed(rest: DataFrame) -> DataFrame:
    """rest (shingle, node, n, part) with the block of each node.

    A node's block is that of one of its lists, a large one if it has any, cut into parts of BLOCK nodes;
    so nodes that share lists share few blocks.
    """
    sizes = rest.groupBy("shingle").agg(F.count("*").alias("size"))
    choice = F.struct((F.col("size") <= 64).alias("small"), "shingle", "size")
    home = rest.join(sizes, "shingle").groupBy("node").agg(F.min(choice).alias("home"))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("home.size") / BLOCK))
    return rest.join(home.select("node", F.xxhash64("home.shingle", salt).alias("block")), "node")


def _passes(volume: int | None, most: int, key: str) -> list[str]:
    """Conditions that deal rows by key to as many passes as keep each under `most` of the volume, about."""
    n = max(1, -(-(volume or 0) // most))
    return [f"pmod(xxhash64({key}, 7), {n}) = {i}" for i in range(n)]


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _asked(steps: Steps, placed: DataFrame, percent: int) -> list[DataFrame]:
    """(node, part, block): blocks with which a node shares enough short lists, with other components in them.

    A node meets every block of its lists, which is more rows than its lists where these are long; so nodes take turns.
    """
    lists = placed.groupBy("shingle", F.col("block").alias("asked")).agg(F.min("part").alias("low"), F.max("part").alias("high"))
    least = _needed(f"(n * {percent} + 99) div 100", percent)
    met = placed.groupBy("shingle").agg((F.count("*") * F.countDistinct("block")).alias("met")).agg(F.sum("met")).first()[0]
    out = []
    for turn in _passes(met, MET, "node"):
        rows = placed.where(turn).select("shingle", "node", "n", "part").join(lists, "shingle").where("low <> part or high <> part")
        counted = rows.groupBy("node", "n", "part", F.col("asked").alias("block")).agg(F.count("*").alias("lists"))
        out.append(steps.stored(counted.where(f"lists >= {least}").select("node", "part", "block")))
    return out


def _promising(placed: DataFrame, asked: DataFrame, percent: int) -> DataFrame:
    """(block, asks, node, part, n): of `asked` and of the nodes of its blocks those that make candidates.

    The lists alone tell: two nodes of different components share only lists of `placed`. So sets travel for candidates only.
    """
    names = ["block", "asks", "node", "part", "n"]

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, hit = None, Lists(percent), set()

        def members() -> list[tuple]:
            return [(key, False, block.nodes[i], block.parts[i], block.sizes[i]) for i in sorted(hit)]

        for batch in batches:
            found = []
            for own, asks, node, part, n, shingles in zip(*(batch.column(c).to_pylist() for c in [*names, "lists"]), strict=True):
                if own != key:
                    found += members()
                    key, block, hit = own, Lists(percent), set()
                if not asks:
                    block.add(node, part, n, shingles)
                elif places := set(block.candidates(node, part, n, shingles)):
                    hit |= places
                    found.append((own, True, node, part, n))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in found], schema)
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in members()], schema)

    schema = pa.schema([pa.field(c, pa.bool_() if c == "asks" else pa.int64()) for c in names])
    lists = placed.groupBy("node", "n", "part", "block").agg(F.collect_list("shingle").alias("lists"))
    active, blocks = asked.select("node").distinct(), asked.select("block").distinct()
    homes = lists.join(active, "node").join(blocks, "block").withColumn("asks", F.lit(False))
    asks = asked.select("node", "block").join(lists.drop("block"), "node").withColumn("asks", F.lit(True))
    rows = homes.unionByName(asks).select(*names, "lists").repartition("block").sortWithinPartitions("block", "asks")
    return rows.mapInArrow(meet, "block long, asks boolean, node long, part long, n long")


def _searched(steps: Steps, met: DataFrame, sets: DataFrame, long_lists, percent: int) -> list[DataFrame]:
    """Links (a, b) between components, found block by block.

    The sets of a block travel ahead of the sets that ask for it; a task holds one block and one batch. Blocks take turns,
    so that about SHIPPED bytes of sets are on their way at a time.
    """

    def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, block, last = None, None, None
        for batch in batches:
            found = []
            for own, asks, node, part, raw in batch[["block", "asks", "node", "part", "items"]].itertuples(index=False):
                if own != key:
                    key, block = own, Block(long_lists.value, percent)
                if (own, asks, node) == last:  # a set may come twice
                    continue
                last, items = (own, asks, node), np.frombuffer(raw, np.uint64)
                if asks:
                    found += [(node, other) for other in block.links(node, part, items)]
                else:
                    block.place(node, part, items)
            yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    out = []
    for turn in _passes(met.agg(F.sum("n")).first()[0], SHIPPED // 8, "block"):
        rows = met.where(turn)
        rows = rows.join(among(sets, rows.select("node").distinct()), "node")
        out.append(steps.stored(rows.repartition("block").sortWithinPartitions("block", "asks", "node").mapInPandas(search, "a long, b long")))
    return out


def components(steps: Steps, links: DataFrame) -> DataFrame:
    """(node, part): the smallest node of each linked node's component, by large and small stars in turn."""
    edges = steps.stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = steps.stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last, edges = edges, steps.stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        steps.drop(last, large)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("part"))
    out = steps.stored(nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("part"))).distinct())
    steps.drop(edges)
    return out


def jaccard_classes(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs: the smallest doc_id reachable by links."""
    if percent < 51:
        raise ValueError("percent must be above 50: below, two short lists may not be shared")
    spark = docs.sparkSession
    steps = Steps(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = steps.stored(profiles(docs.where("doc_id is not null"), k))
    rows = both.where("doc_id is not null")
    common = both.where("doc_id is null").groupBy("node").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "node").limit(LONG_LISTS)
    hot = np.array([r["node"] for r in common.select("node").toLocalIterator()], np.int64).view(np.uint64)
    long_lists = spark.sparkContext.broadcast(np.sort(hot))
    first = steps.stored(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")))

    posted = short_lists(docs, long_lists, k, percent).repartition("shingle")
    shared = posted.groupBy("shingle").agg(F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("most"))
    shared = shared.where("least.node <> most").select("shingle", F.col("least.node").alias("centre"), F.col("least.n").alias("n_centre"))
    entries = steps.stored(posted.join(shared, "shingle").distinct())

    near = entries.where(f"node <> centre and {_fits('n', 'n_centre', percent)}").groupBy(F.col("node").alias("a"), F.col("centre").alias("b"), "n", "n_centre")
    near = near.agg(F.count("*").alias("lists")).where(f"lists >= least({_needed('n', percent)}, {_needed('n_centre', percent)})")
    near = steps.stored(near.select("a", "b"))
    sets = steps.stored(node_sets(docs, _ends(near), first, k))
    star = steps.stored(_verified(near, sets, percent))
    parts = components(steps, star)

    named = entries.join(parts, "node", "left").select("shingle", "node", "n", F.coalesce("part", "node").alias("part"))
    mixed = named.groupBy("shingle").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("shingle")
    rest = steps.stored(named.join(mixed, "shingle", "left_semi"))
    steps.drop(near, entries, parts)
    placed = steps.stored(_placed(rest))
    steps.drop(rest)
    asked = _asked(steps, placed, percent)
    met = steps.stored(_promising(placed, _union(asked), percent))
    steps.drop(placed, *asked)
    others = steps.stored(node_sets(docs, met.select("node").distinct().join(sets.select("node"), "node", "left_anti"), first, k))
    more = _searched(steps, met, sets.unionByName(others), long_lists, percent)
    steps.drop(first, sets, others, met)

    # Documents reach each other through nodes; an id that several rows share ties their nodes together too.
    several = rows.where("n > 0").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    ties = rows.join(several, "doc_id").select(F.col("a"), F.col("node").alias("b"))
    whole_parts = components(steps, _union([star, *more, ties]))
    steps.drop(star, *more)
    named = rows.join(whole_parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    heads = named.where("n > 0").groupBy("part").agg(F.min("doc_id").alias("head"))
    out = named.join(heads, "part", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("doc_id")).alias("component_id"))
    nameless = docs.where("doc_id is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)
