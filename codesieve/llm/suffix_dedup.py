"""Repeated 100-byte strings, found by sorting suffixes deep and shallow, and removed.

Every byte covered by a string of WIDTH bytes that also starts earlier (in a document with a smaller id, or
earlier in the same document) is removed; all strings are judged on the input.

Sorting every suffix of a large corpus would move each byte many times. Anchors bring the candidates
together first: of the K-byte substrings inside each WIDTH-byte window those with the smallest hash are
anchors, so equal windows have equal anchors at equal places. Then:

1. Anchors are dealt by hash with a digest of their context, LEFT bytes before and WIDTH bytes from the anchor,
   which holds all windows around it. Of anchors with equal contexts only the first stays in question: in the
   others every window is repeated. Anchors that stand alone are dropped.
2. Where one hash has several contexts that agree in the 40 bytes on one side, the first anchor of each is
   looked up in its text, and all suffixes that
   begin in its context are sorted within their hash: multikey quicksort by eight bytes at a time to SHALLOW
   bytes, where suffixes that stand alone are left aside; the groups that remain share a long prefix and are
   ordered by a blind trie, which branches at the first byte in which a suffix differs from the first one of
   its group. Suffixes that agree in WIDTH bytes are equal windows; all but the earliest are repeated.
3. Repeated windows are merged to runs per document and cut out.

Groups of more than GROUP contexts are not sorted in one task: their windows are hashed to rows, and Spark
takes the first of each (partial minima, then a join).

Nulls: a null text has no bytes; documents without id keep all bytes and take no part. Rows that repeat an
id count as one document for the order, and a start in both as one earlier than the other; equal rows are cut alike. Texts below WIDTH bytes keep all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.common import stored

WIDTH, K = 100, 20
LEFT = WIDTH - K
SHALLOW = 24
GROUP = 100_000
SEGMENT = 1 << 20
BUFFER = 1 << 15
SLICE = 500
PAD = 192


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i : i + width], for every i that has width values."""
    out, have = x, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(x) - width + 1], out[width - have :]) if have < width else out


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the 16-byte and of the K-byte substrings at each position, by doubling."""
    x = data.astype(np.uint64) + np.uint64(1)
    levels = {1: x}
    for size in (1, 2, 4, 8):
        x = _join(x[:-size], x[size:], size)
        levels[2 * size] = x
    n = len(data) - K + 1
    return x, _mix(_join(levels[16][:n], levels[4][16 : 16 + n], 16))


def _join(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + b
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, their K-byte hashes, 16-byte hashes everywhere) of the anchors in a buffer.

    Windows may begin at starts[i] up to before ends[i]; around each such range the buffer has PAD bytes.
    """
    sixteen, gram = _grams(data)
    low = _slide(gram, LEFT + 1, np.minimum)  # one per window
    steps = np.zeros(len(low) + 1, np.int8)
    steps[starts] += 1
    steps[ends] -= 1
    low[np.cumsum(steps[:-1]) == 0] = 0
    edge = np.zeros(LEFT, np.uint64)
    best = _slide(np.r_[edge, low, edge], LEFT + 1, np.maximum)
    at = np.flatnonzero((best == gram) & (best > 0))
    return at, gram[at], sixteen


def _pieces(raw: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(first byte, last byte, first window, last window) of overlapping pieces of a text; bytes hold all contexts."""
    last = len(raw) - WIDTH + 1
    for start in range(0, last, SEGMENT):
        end = min(last, start + SEGMENT)
        yield max(0, start - LEFT), min(len(raw), end + LEFT + 2 * WIDTH), start, end


def _posted(pieces: list[tuple]) -> tuple[np.ndarray, ...]:
    """h, context, halves, doc_id, rid, p and again of the anchors of (doc_id, rid, length, first byte, first and last window, bytes)."""
    pad = b"\0" * PAD
    data = np.frombuffer(pad + pad.join(x[6] for x in pieces) + pad, np.uint8)
    doc, rid, length, first, low, high = (np.array(c, np.int64) for c in list(zip(*pieces, strict=True))[:6])
    sizes = np.array([len(x[6]) for x in pieces])
    base = PAD + np.r_[0, np.cumsum(sizes + PAD)[:-1]]  # where each piece's bytes begin
    at, gram, sixteen = anchors(data, base + low - first, base + high - first)
    own = np.searchsorted(base, at, side="right") - 1
    p = at - base[own] + first[own]
    context = np.minimum(p, LEFT).astype(np.uint64) * np.uint64(256) + np.minimum(length[own] - p, WIDTH).astype(np.uint64)
    for offset in (*range(-LEFT, WIDTH - 16, 16), WIDTH - 16):
        context = _mix(context ^ sixteen[at + offset])
    left, right = (_mix(_mix(sixteen[at + a] ^ _mix(sixteen[at + b])) ^ sixteen[at + c]) for a, b, c in ((-40, -24, -16), (K, K + 16, K + 24)))
    halves = (left & np.uint64(0xFFFFFFFF00000000)) | (right >> np.uint64(32))
    # Later anchors of a text with the context of an earlier one: repeated for certain, and not to be compared.
    again = np.ones(len(at), np.int64)
    again[np.unique(_mix(gram ^ _mix(context + own.astype(np.uint64))), return_index=True)[1]] = 0
    gram = np.where(again == 1, _mix(gram + _mix(p.astype(np.uint64) + own.astype(np.uint64))), gram)  # dealt anywhere
    return gram.view(np.int64), context.view(np.int64), halves.view(np.int64), doc[own], rid[own], p, again


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def posts(docs: DataFrame) -> DataFrame:
    """(h, context, halves, doc_id, rid, p, again): the anchors of every text.

    again is 1 for those whose context the text has before; their h is arbitrary, so that a text that repeats
    two words a million times makes no hot key. halves has two 32-bit hashes: of the 40 bytes before the anchor and of the 40 bytes behind its K bytes. Every
    window around the anchor holds one of both whole.
    """
    names = ["h", "context", "halves", "doc_id", "rid", "p", "again"]

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            pieces, held = [], 0
            for doc_id, rid, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rid", "text")), strict=True):
                raw = (text or "").encode()
                for first, last, low, high in _pieces(raw):
                    pieces.append((doc_id, rid, len(raw), first, low, high, raw[first:last]))
                    held += last - first
                    if held > BUFFER:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _posted(pieces)], names)
                        pieces, held = [], 0
            if pieces:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _posted(pieces)], names)

    return docs.mapInArrow(post, ", ".join(f"{c} long" for c in names))


def contexts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h, doc_id, rid, p, n_left, bytes) of the anchors (h, rid, p)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "doc_id", "rid", "p", "n_left", "bytes"]
        for batch in _slices(batches):
            rows: list[tuple] = []
            for doc_id, rid, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rid", "text", "places")), strict=True):
                raw = (text or "").encode()
                for x in places:
                    low = max(0, x["p"] - LEFT)
                    rows.append((x["h"], doc_id, rid, x["p"], x["p"] - low, raw[low : x["p"] + WIDTH]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                    rows = []
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("p", pa.int64()), ("n_left", pa.int64()), ("bytes", pa.binary())])
    places = firsts.groupBy("rid").agg(F.collect_set(F.struct("h", "p")).alias("places"))
    rows = docs.dropDuplicates(["doc_id", "rid"]).join(places, "rid")
    return rows.select("doc_id", "rid", "text", "places").mapInArrow(cut, "h long, doc_id long, rid long, p long, n_left long, bytes binary")


def _eight(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number in byte order."""
    return text[at[:, None] + np.arange(8)].view(">u8").ravel().astype(np.uint64)


def sorted_groups(text: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Number of the set of equal suffixes (first WIDTH bytes, same group) each suffix is in; -1 if alone.

    text holds WIDTH bytes behind every position in `at`.
    """
    out = np.full(len(at), -1)
    left = np.arange(len(at))
    for depth in range(0, SHALLOW, 8):  # multikey quicksort, eight bytes a key
        key = _eight(text, at[left] + depth)
        order = np.lexsort((key, group))
        left, key, group = left[order], key[order], group[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])] if len(left) else np.empty(0, bool)
        group = np.cumsum(new)
        twice = np.bincount(group)[group] > 1 if len(group) else np.empty(0, bool)
        left, group = left[twice], group[twice]
        if not len(left):
            return out
    # Blind trie: each round, suffixes equal to the first of their group are done, the others branch at their first other byte.
    done = 0
    deep = np.arange(SHALLOW, WIDTH)
    while len(left):
        order = np.argsort(group, kind="stable")
        left, group = left[order], group[order]
        new = np.r_[True, group[1:] != group[:-1]]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        differs = text[at[left][:, None] + deep] != text[at[left[first]][:, None] + deep]
        same = ~differs.any(axis=1)
        out[left[same]] = done + np.cumsum(new)[same]
        done += int(new.sum()) + 1
        branch = differs[~same].argmax(axis=1)
        left, group = left[~same], np.cumsum(new)[~same]
        if len(left):
            byte = text[at[left] + SHALLOW + branch].astype(np.int64)
            _, group = np.unique((group.astype(np.int64) * WIDTH + branch) * 256 + byte, return_inverse=True)
            several = np.bincount(group)[group] > 1
            left, group = left[several], group[several]
    alone = np.bincount(out[out >= 0], minlength=1)[out] == 1
    out[alone & (out >= 0)] = -1
    return out


def repeated_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Per context (rows: h, doc_id, rid, p, n_left, bytes) its outermost repeated windows, as (rid, start, end)."""
    frame = frame.sort_values(["doc_id", "p", "rid"], kind="stable").reset_index(drop=True)
    sizes = frame["bytes"].str.len().to_numpy()
    n_left = frame["n_left"].to_numpy()
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    text = np.frombuffer(b"".join(frame["bytes"]) + b"\0" * WIDTH, np.uint8)
    group = np.unique(frame["h"].to_numpy(), return_inverse=True)[1]
    low, high = np.full(len(frame), WIDTH), np.full(len(frame), -1)  # bytes of the outermost windows before the anchor
    place = frame[["doc_id", "p", "rid"]].to_numpy()
    for o in range(LEFT + 1):
        own = np.flatnonzero((n_left >= o) & (sizes - n_left >= WIDTH - o))
        if len(own) < 2:
            continue
        sets = sorted_groups(text, base[own] + n_left[own] - o, group[own])
        kept = np.flatnonzero(sets >= 0)  # in order of place: a set's first entry is its earliest
        _, first = np.unique(sets[kept], return_index=True)
        _, number = np.unique(sets[kept], return_inverse=True)
        lead = own[kept[first[number]]]
        again = own[kept][(place[own[kept]] != place[lead]).any(axis=1)]
        high[again] = o
        low[again] = np.minimum(low[again], o)
    hit = high >= 0
    p = frame["p"].to_numpy()
    return pd.DataFrame({"rid": frame["rid"].to_numpy()[hit], "start": (p - high)[hit], "end": (p - low + WIDTH)[hit]})


def _window_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """(h, o, window, doc_id, rid, p): two 64-bit hashes joined as text would be large, so one of the bytes and one seeded."""
    out = []
    for h, doc_id, rid, p, n, raw in frame[["h", "doc_id", "rid", "p", "n_left", "bytes"]].itertuples(index=False):
        for o in range(LEFT + 1):
            if n >= o and len(raw) - n >= WIDTH - o:
                out.append((h, doc_id, rid, p, o, bytes(raw[n - o : n - o + WIDTH])))
    return pd.DataFrame(out, columns=["h", "doc_id", "rid", "p", "o", "window"])


def marked_windows(found: DataFrame, group_size: int = GROUP) -> DataFrame:
    """(rid, start, end) of repeated windows among contexts."""
    sizes = found.groupBy("h").agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > group_size).select("h")

    def work(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole groups of a sorted partition, some thousands of contexts at a time."""
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rest) < 20_000:
                continue
            ended = rest["h"].to_numpy() != rest["h"].iat[-1]
            if ended.any():
                yield repeated_windows(rest[ended])
                rest = rest[~ended]
        if rest is not None and len(rest):
            yield repeated_windows(rest)

    small = found.join(large, "h", "left_anti").repartition("h").sortWithinPartitions("h")
    marks = small.mapInPandas(work, "rid long, start long, end long")

    def windows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                yield _window_rows(batch.iloc[start : start + 500])

    rows = found.join(large, "h", "left_semi").mapInPandas(windows, "h long, doc_id long, rid long, p long, o long, window binary")
    rows = rows.select("h", "doc_id", "rid", "p", "o", F.sha2("window", 256).alias("window"))
    firsts = rows.groupBy("h", "o", "window").agg(F.min(F.struct("doc_id", "p", "rid")).alias("lead"))
    again = rows.join(firsts, ["h", "o", "window"]).where("not (doc_id = lead.doc_id and p = lead.p and rid = lead.rid)")
    return marks.unionByName(again.select("rid", (F.col("p") - F.col("o")).alias("start"), (F.col("p") - F.col("o") + WIDTH).alias("end")))


def repeated_spans(docs: DataFrame, group_size: int = GROUP) -> DataFrame:
    """(rid, spans): per document (with doc_id, rid, text) the byte ranges of repeated windows, not yet merged."""
    posted = posts(docs.where("doc_id is not null")).repartition("h")
    own, alike = Window.partitionBy("h"), Window.partitionBy("h", "context")
    place = F.struct("doc_id", "p", "rid")
    table = posted.withColumn("first", place == F.min(place).over(alike)).withColumn("mixed", F.min("context").over(own) != F.max("context").over(own))
    table = stored(table.where("again = 1 or not first or mixed").drop("mixed", "context"))
    whole = table.where("again = 1 or not first").select("rid", F.greatest(F.col("p") - LEFT, F.lit(0)).alias("start"), (F.col("p") + WIDTH).alias("end"))
    # A window that two contexts share holds one half of both: others need not be looked up.
    asked = table.where("again = 0 and first").select("h", "rid", "p", F.shiftrightunsigned("halves", 32).alias("left"), F.expr("halves & 4294967295").alias("right"))
    near = [F.count("*").over(Window.partitionBy("h", side)) > 1 for side in ("left", "right")]
    asked = asked.repartition("h").withColumn("near", near[0]).withColumn("near_too", near[1]).where("near or near_too").select("h", "rid", "p")
    marks = marked_windows(stored(contexts(docs, asked)), group_size)
    both = whole.unionByName(marks)
    return both.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(spans: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges, cut at n."""
    out: list[tuple[int, int]] = []
    for start, end in spans[np.argsort(spans[:, 0], kind="stable")].tolist() if len(spans) else []:
        end = min(end, n)
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, group_size: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, runs (byte ranges taken out) and kept (the remaining bytes) of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.xxhash64("doc_id", "text"))
    spans = stored(repeated_spans(keyed, group_size))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                raw = (text or "").encode()
                runs = merged(np.array([(x["start"], x["end"]) for x in spans or []], np.int64).reshape(-1, 2), len(raw))
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append({"doc_id": doc_id, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "runs": [{"start": a, "end": b} for a, b in runs], "kept": kept})
            yield pa.RecordBatch.from_pylist(rows, schema)

    run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("runs", pa.list_(run)), ("kept", pa.binary())])
    rows = keyed.join(spans, "rid", "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, runs array<struct<start: long, end: long>>, kept binary")
