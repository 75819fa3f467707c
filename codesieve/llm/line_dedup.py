"""Line de-duplication with sharded cuckoo filters over exact reference-count tables.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased. Keys of at
least `min_chars` code points that occur in two or more documents keep their lines in the document
with the smallest id and lose them elsewhere.

State (`LineStore`) is three tables, so that inserting and deleting documents is reversible:

* postings: one row per document and distinct key (128-bit digest as two longs), the exact record;
* refs: per key its number of documents, smallest and largest document id, the reference counts;
* filters: per shard of keys one cuckoo filter of the keys that now occur in two or more documents.

Lines meet their shard's filter first; only its hits (true repeats and about 1 in 8,000 others) are
joined with the exact counts, so most lines never reach that join. A cuckoo filter, unlike a Bloom
filter, forgets a key again when deletions leave it in one document.

Nulls: a null text is one empty line; a document without id keeps all its lines and takes no part.
Rows that repeat an id count as one document. Very long texts are cut whole, row by row. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import stored

MIN_CHARS = 10
SHARD_KEYS = 200_000
SALTS = 16
SLICE = 500
SPACES = " \t\n\x0b\x0c\r"
TO_LOWER = {c: c + 32 for c in range(65, 91)}
KEY = ["h", "g"]


class CuckooFilter:
    """16-bit fingerprints in buckets of four slots; whole arrays of hashes per call.

    The bulk insertion works in rounds: every pending fingerprint goes to a free slot of its bucket
    or swaps with a resident, which then tries its other bucket.
    """

    SLOTS = 4
    MOST = 0.9

    def __init__(self, n_keys: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n_keys) / self.SLOTS / 0.8))))
            table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.table = table

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(blob, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = hashes.astype(np.int64).view(np.uint64)
        fp = (h >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        first = (h & np.uint64(len(self.table) - 1)).astype(np.int64)
        return fp, first, self._other(first, fp)

    def _other(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        step = (fp.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ (step & np.uint64(len(self.table) - 1)).astype(np.int64)

    def room(self) -> int:
        """Fingerprints that still fit without crowding the buckets."""
        return int(self.MOST * self.table.size) - int(np.count_nonzero(self.table))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(hashes)
        both = (self.table[a] == fp[:, None]) | (self.table[b] == fp[:, None])
        return both.any(axis=1)

    def insert(self, hashes: np.ndarray, seed: int = 1) -> bool:
        """False if the filter is too full; it then has to be built anew with more buckets."""
        fp, at, _ = self._places(hashes)
        rng = np.random.default_rng(seed)
        for _ in range(200):
            if not len(fp):
                return True
            order = np.argsort(at, kind="stable")
            fp, at = fp[order], at[order]
            first = np.r_[True, at[1:] != at[:-1]]
            rank = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            free = self.table[at] == 0
            fits = free.sum(axis=1) > rank
            if fits.any():
                slot = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
                self.table[at[fits], slot] = fp[fits]
            fp, at, first = fp[~fits], at[~fits], first[~fits]
            if not len(fp):
                return True
            one = np.r_[True, at[1:] != at[:-1]]
            slot = rng.integers(0, self.SLOTS, int(one.sum()))
            resident = self.table[at[one], slot].copy()
            self.table[at[one], slot] = fp[one]
            fp[one] = resident
            at = self._other(at, fp)
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Forget keys that were inserted; each takes one copy of its fingerprint away."""
        for fp, a, b in zip(*self._places(hashes), strict=True):
            for bucket in (a, b):
                found = np.flatnonzero(self.table[bucket] == fp)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break


@dataclass
class LineStore:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    n_shards: int


def line_key(line: str) -> str:
    return line.strip(SPACES).translate(TO_LOWER)


def digest(key: str) -> tuple[int, int]:
    """Two signed 64-bit halves of a 128-bit hash."""
    raw = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, g, doc_id): the distinct keys of each document row that has an id."""

    names = ["h", "g", "doc_id"]

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = {k for line in (text or "").split("\n") if len(k := line_key(line)) >= min_chars}
                    rows += [(*digest(k), doc_id) for k in own]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3, names)

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(keys, "h long, g long, doc_id long")


def reference_counts(posted: DataFrame) -> DataFrame:
    """Per key: documents (as rows), smallest and largest id. Partial sums first, so no key is hot."""
    return posted.groupBy(*KEY).agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


def _repeated(refs: DataFrame) -> DataFrame:
    return refs.where("first_doc <> last_doc")


def _shard(n_shards: int):
    return F.pmod(F.col("g"), F.lit(n_shards)).cast("int")


def _updated(filters: DataFrame | None, changes: DataFrame, n_shards: int) -> DataFrame:
    """Apply changes (h, g, add) to the filters; one group is one shard of at most some 200,000 keys.

    A filter that the changes do not fit into comes back without its blob, to be rebuilt from its shard's keys; one
    that is new grows until its keys fit.
    """

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        adds = new.loc[new["add"], "h"].to_numpy()
        if len(old):
            held = CuckooFilter.load(old["blob"].iloc[0])
            held.delete(new.loc[~new["add"], "h"].to_numpy())
            blob = held.dump() if held.room() >= len(adds) and held.insert(adds) else None
        else:
            size = len(adds)
            held = CuckooFilter(size)
            while not held.insert(adds):
                size *= 2
                held = CuckooFilter(size)
            blob = held.dump()
        return pd.DataFrame({"shard": [key[0]], "blob": [blob]})

    spark = changes.sparkSession
    if filters is None:
        filters = spark.createDataFrame([], "shard int, blob binary")
    sharded = changes.select(_shard(n_shards).alias("shard"), "h", "add")
    return filters.groupBy("shard").cogroup(sharded.groupBy("shard")).applyInPandas(apply, "shard int, blob binary")


def build(docs: DataFrame, min_chars: int = MIN_CHARS) -> LineStore:
    """A store of all documents."""
    posted = stored(postings(docs, min_chars))
    refs = stored(reference_counts(posted))
    repeated = _repeated(refs)
    n_shards = max(8, -(-repeated.count() // SHARD_KEYS))
    filters = stored(_updated(None, repeated.select(*KEY, F.lit(True).alias("add")), n_shards))
    return LineStore(posted, refs, filters, n_shards)


def insert(store: LineStore, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineStore:
    """Add documents whose ids the store does not hold yet, be they ever so many: a filter that overflows is rebuilt from
    the keys of its shard, and all filters are if there are more shards."""
    new = stored(postings(docs, min_chars))
    both = stored(store.postings.unionByName(new))
    added = store.refs.unionByName(reference_counts(new)).groupBy(*KEY)
    refs = stored(added.agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")))
    return _with_filters(store, both, refs)


def remove(store: LineStore, doc_ids: DataFrame) -> LineStore:
    """Delete documents: afterwards the store is as if they had never been inserted."""
    ids = doc_ids.select("doc_id").distinct()
    gone = store.postings.join(ids, "doc_id", "left_semi").select(*KEY).distinct()
    left = stored(store.postings.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id"))
    counted = reference_counts(left.join(gone, KEY, "left_semi"))
    refs = stored(store.refs.join(gone, KEY, "left_anti").unionByName(counted))
    return _with_filters(store, left, refs)


def _with_filters(store: LineStore, posted: DataFrame, refs: DataFrame) -> LineStore:
    was, now = _repeated(store.refs).select(*KEY), _repeated(refs).select(*KEY)
    n_shards = max(8, -(-now.count() // SHARD_KEYS))
    adds, dels = now.join(was, KEY, "left_anti"), was.join(now, KEY, "left_anti")
    if n_shards > store.n_shards:
        return LineStore(posted, refs, stored(_updated(None, now.withColumn("add", F.lit(True)), n_shards)), n_shards)
    changes = adds.withColumn("add", F.lit(True)).unionByName(dels.withColumn("add", F.lit(False)))
    filters = stored(_updated(store.filters, changes, store.n_shards))
    full = filters.where("blob is null").select("shard")
    if not full.isEmpty():
        anew = now.withColumn("shard", _shard(store.n_shards)).join(F.broadcast(full), "shard", "left_semi")  # a row per shard
        anew = _updated(None, anew.select(*KEY, F.lit(True).alias("add")), store.n_shards)
        filters = stored(filters.where("blob is not null").unionByName(anew))
    return LineStore(posted, refs, filters, store.n_shards)


def maybe_repeated(lines: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """The lines (h, g, doc_id) whose shard's filter has their key.

    Filters travel as rows ahead of the lines of their shard and are replaced when the next shard
    begins, so a task holds one filter and one batch. Shards are salted by document: a key that a
    third of all documents hold is spread over SALTS tasks.
    """

    def probe(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, part = None, None
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            shard = batch["shard"].to_numpy()
            ends = np.r_[np.flatnonzero((shard[1:] != shard[:-1]) | batch["blob"].notna().to_numpy()[1:]) + 1, len(batch)]
            h, start = batch["h"].to_numpy(), 0
            for end in ends:
                blob = batch["blob"].iat[start]
                if blob is not None and not isinstance(blob, float):
                    held, part = CuckooFilter.load(blob), shard[start]
                    start += 1
                if part is not None and start < end and shard[start] == part:
                    keep[start:end] = held.contains(h[start:end])
                start = end
            yield batch.loc[keep, ["h", "g", "doc_id"]]

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    none = F.lit(None)
    flt = filters.select("shard", salts.alias("salt"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("g"), none.cast("long").alias("doc_id"), "blob")
    rows = lines.select(_shard(n_shards).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), *KEY, "doc_id", none.cast("binary").alias("blob"))
    dealt = flt.unionByName(rows).repartition("shard", "salt")
    return dealt.sortWithinPartitions("shard", "salt", F.col("blob").isNull()).mapInPandas(probe, "h long, g long, doc_id long")


def dropped_keys(store: LineStore) -> DataFrame:
    """(doc_id, keys): per document the keys (as h) whose lines it loses."""
    hits = maybe_repeated(store.postings, store.filters, store.n_shards)
    losing = hits.join(_repeated(store.refs).select(*KEY, "first_doc"), KEY).where("doc_id <> first_doc")
    return losing.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("keys"))


def apply_drops(docs: DataFrame, drops: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with kept (the remaining text), n_lines and n_dropped; docs' own columns stay.

    A column of docs named keys, kept, n_lines or n_dropped is replaced by the operator's.
    """

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def keep(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = []
        for text, gone in zip(texts, keys, strict=True):
            lines = (text or "").split("\n")
            if gone is None or not len(gone):
                out.append((text or "", len(lines), 0))
                continue
            lost = {(x["h"], x["g"]) for x in gone}
            left = [x for x in lines if len(k := line_key(x)) < min_chars or digest(k) not in lost]
            out.append(("\n".join(left), len(lines), len(lines) - len(left)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    own = [c for c in docs.columns if c not in ("keys", "kept", "n_lines", "n_dropped", "_r")]
    joined = docs.select(*own).join(drops, "doc_id", "left")
    return joined.select(*own, keep("text", "keys").alias("_r")).select(*own, "_r.*")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with repeated lines taken out: columns kept, n_lines and n_dropped are added."""
    return apply_drops(docs, dropped_keys(build(docs, min_chars)), min_chars)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
