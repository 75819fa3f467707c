"""Vector code compression: integer codebooks per part position, assigned through a trie over distinct parts.

Each component x becomes the integer floor(256 x) and a vector is cut into PARTS equal parts (filled with zeros at its end
if its length is no multiple). The codebook of a position starts as that part of the first ENTRIES rows by vec_id;
each round assigns every part to the nearest entry (squared distance, ties to the lower index) and moves an entry to the
componentwise floor of the mean of its parts; an entry without parts stays.

Assignment walks a lexicographic trie. A task sorts the distinct parts of a slice of rows; a node is a range of sorted
parts with a common prefix and holds the vector of distances that this prefix has to all entries. The walk goes
depth first, and a child adds one component to its parent's vector, so each prefix is computed once however many parts share
it; ranges of up to BLOCK parts are finished level by level as matrices. A leaf takes the least entry and adds its part,
weighted by its copies, to the entry's sum. So copies of a vector that fill a third of the table cost one leaf a slice,
no part is shuffled, and a task passes on one row per position and entry and component, whatever its rows.

Codebooks are ENTRIES x length integers, a bound that does not depend on the rows; only they meet on the driver.

Nulls: vectors that are null or empty, or hold null or non-finite components, take no part; nor do those of another length
than most (ties: the shorter). A null label is a label of its own. Rows without vec_id are encoded but never start an
entry (if all are, the one entry is zero). Repeated rows count as often as they occur. Components beyond +-sqrt(2^60 / length) count as that bound, so that
errors stay within long. Other columns are left out, so names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
BLOCK = 4096
SLICE = 1 << 16
MOST_LABELS = 1_000_000
SALTS = 64


def whole_numbers(rows: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """(vec_id, label, v array<long> of the rows that take part; the length of v)."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")).where(v.isNotNull() & (F.size(v) > 0)).where(~F.coalesce(bad, F.lit(True)))
    common = rows.groupBy(F.size(v).alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    own = common["n"] if common else parts
    length = -(-own // parts) * parts
    most = int((2**60 / length) ** 0.5)

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(SCALE * _matrix(batch.column("v"), own, np.float64))
            x = np.pad(np.clip(x, -most, most).astype(np.int64), ((0, 0), (0, length - own)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _lists(x)], ["vec_id", "label", "v"])

    types = dict(rows.dtypes)
    return rows.where(F.size(v) == own).mapInArrow(convert, f"vec_id {types['vec_id']}, label {types['label']}, v array<long>"), length


def _matrix(column: pa.Array, length: int, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, length)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))


def _runs(column: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """True where a run of equal prefixes begins, given the runs of the prefix one component shorter."""
    return breaks | np.r_[True, column[1:] != column[:-1]]


def nearest_entries(parts: np.ndarray, entries: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of distinct parts in lexicographic order, by a depth-first walk of their trie."""
    n, width = parts.shape
    best, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stack = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []  # range of parts, length of their common prefix, its distances
    while stack:
        low, high, depth, distances = stack.pop()
        if high - low <= block or depth == width:
            level, breaks = distances[None, :], np.r_[True, np.zeros(high - low - 1, bool)]
            for at in range(depth, width):
                column = parts[low:high, at]
                parent = np.cumsum(breaks) - 1
                breaks = _runs(column, breaks)
                level = level[parent[breaks]] + (column[breaks, None] - entries[None, :, at]) ** 2
            best[low:high] = level.argmin(1)
            least[low:high] = level.min(1)
            continue
        column = parts[low:high, depth]
        starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1], True])
        children, first = [], 0
        for i in range(1, len(starts)):  # small neighbours stay one range under their parent, a large child goes deeper
            if starts[i] - starts[first] > block and i - 1 > first:
                children.append((first, i - 1))
                first = i - 1
            if starts[i] - starts[first] > block or i == len(starts) - 1:
                children.append((first, i))
                first = i
        for a, b in reversed([c for c in children if c[0] < c[1]]):
            span = low + int(starts[a]), low + int(starts[b])
            if b - a == 1:
                stack.append((*span, depth + 1, distances + (column[starts[a]] - entries[:, depth]) ** 2))
            else:
                stack.append((*span, depth, distances))
    return best, least


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct parts in lexicographic order, place of each part among them, copies of each)."""
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    first = np.r_[True, (ranked[1:] != ranked[:-1]).any(1)] if len(parts) else np.zeros(0, bool)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(first) - 1
    return ranked[first], place, np.bincount(place, minlength=int(first.sum()))


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about SLICE rows, so that a trie has prefixes to share."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SLICE:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _rows_of(table: pa.Table, length: int) -> np.ndarray:
    return np.concatenate([_matrix(c, length, np.int64) for c in table.column("v").chunks] or [np.empty((0, length), np.int64)])


def first_codebooks(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """parts x entries x components; fewer entries if there are fewer rows."""
    starts = rows.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).select("v").toArrow()
    x = _rows_of(starts, length)
    return np.ascontiguousarray(x.reshape(len(x), parts, length // parts).transpose(1, 0, 2))


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for table in _slices(batches):
            x = _rows_of(table, parts * width).reshape(-1, parts, width)
            for i in range(parts):
                keys, _, copies = distinct_parts(x[:, i])
                own, _ = nearest_entries(keys, shared.value[i])
                np.add.at(sums[i], own, keys * copies[:, None])
                np.add.at(counts[i], own, copies)
        part, entry = np.nonzero(counts)
        at = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        columns = [part, entry, at, sums[part, entry, at], counts[part, entry]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "at", "total", "n"])

    partial = rows.mapInArrow(assign, "part long, entry long, at long, total long, n long")
    found = partial.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
    shared.destroy()
    books = books.copy()
    part, entry, at, total, n = (found.column(c).to_numpy() for c in ("part", "entry", "at", "total", "n"))
    books[part, entry, at] = total // n
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, codes array<int>, error) of rows of whole_numbers."""
    parts, _, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches):
            x = _rows_of(table, parts * width).reshape(-1, parts, width)
            codes, error = np.zeros((len(x), parts), np.int32), np.zeros(len(x), np.int64)
            for i in range(parts):
                keys, place, _ = distinct_parts(x[:, i])
                own, least = nearest_entries(keys, shared.value[i])
                codes[:, i] = own[place]
                error += least[place]
            columns = [table.column("vec_id").combine_chunks(), table.column("label").combine_chunks(), _lists(codes), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "codes", "error"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(assign, f"vec_id {types['vec_id']}, label {types['label']}, codes array<int>, error long")


def decode(codes: DataFrame, books: np.ndarray, length: int | None = None) -> DataFrame:
    """codes with a column `decoded` (array<long>): the entries that its codes name, cut to `length` components."""
    flat = F.lit(books.reshape(-1).tolist())
    _, entries, width = books.shape
    pieces = F.transform("codes", lambda c, i: F.slice(flat, ((i * entries + c) * width + 1).cast("int"), width))
    vector = F.flatten(pieces)
    return codes.withColumn("decoded", vector if length is None else F.slice(vector, 1, length))


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error of every row that takes part; the final codebooks)."""
    numbers, length = whole_numbers(rows, parts)
    numbers = stored(numbers)
    books = first_codebooks(numbers, length, parts, entries)
    if not books.shape[1]:
        books = np.zeros((parts, 1, length // parts), np.int64)
    for _ in range(rounds):
        books = moved(numbers, books)
    return encode(numbers, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with label_error: the error summed over rows of an equal label.

    The sums are one small row per label: they are broadcast up to MOST_LABELS rows; beyond, both sides are salted.
    """
    codes = stored(codes)
    sums = stored(codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")))
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= MOST_LABELS:
        return codes.join(F.broadcast(sums), same).drop("_label")
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = codes.withColumn("_own", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("_own") == F.col("_salt"))).drop("_label", "_own", "_salt")


def hex_codes(codes: str = "codes"):
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
