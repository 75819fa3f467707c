"""Byte-level BPE by tree concatenation.

A text is cut at the special token, then into pieces by the tokenizer's fixed pattern, and each piece is
merged by rank. Two kinds of long unsplit text are encoded as trees:

* A piece over LEAF bytes: both halves are encoded, then windows of 1, 2, 4, ... tokens on each side of
  the join are encoded again until the window's first and last token are the ones that stood there
  before. A token sequence is the BPE encoding of its bytes exactly if every two neighbours are, so
  agreement at both ends makes the whole exact.
* A text over CHUNK characters: Spark deals its chunks to tasks, which cut them into pieces independently;
  then one task per document joins the pieces of chunks two by two and encodes them. Around each join pieces
  are cut again in growing windows from the last piece that the cut cannot have changed to the first piece end
  on which both sides agree.

Results equal the tokenizers library's encode(text, add_special_tokens=False) and
decode(ids, skip_special_tokens=False). The vocabulary file's path is a parameter.

Nulls: a null text is the empty text, with no ids. Repeated rows are encoded each; ids may be null.
A column of the documents named ids (encode) or decoded (decode) is replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesieve.llm.common import whole

LEAF = 64
CHUNK = 32_768
CACHED_PIECES = 200_000
SLICE = 400
LOOK_AHEAD = 3
# The byte-level pattern, with white space spelled out.
WHITE = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else 256 and on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + len(names) - len(shown))
    return [names[b] for b in range(256)]


class Bpe:
    """Vocabulary and merges of one tokenizer file."""

    held: dict[str, Bpe] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        names = byte_names()
        back = {c: b for b, c in enumerate(names)}
        self.of_byte = [vocab[c] for c in names]
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.ranks, self.made = {}, []  # of a pair of ids as one number; the id that each rank makes
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.no_rank = len(self.made)
        self.pieces = regex.compile(PIECES)
        self.at_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        # Leaves are merged by a compiled routine where ranks and ids have the same order, as it presumes.
        ordered = self.made == sorted(self.made) and not {*self.of_byte} & {*self.made}
        single = {self.bytes_of[i]: i for i in (*self.of_byte, *self.made)}
        self.leaf = tiktoken.Encoding("leaf", pat_str=r"[\s\S]+", mergeable_ranks=single, special_tokens={}).encode_ordinary if ordered else None
        self.known: dict[str, tuple[int, ...]] = {}

    @classmethod
    def load(cls, path: str) -> Bpe:
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def merge(self, data: bytes) -> list[int]:
        """Merge by rank, leftmost first: a scan per merge for short pieces, a heap of pairs for others."""
        ids = [self.of_byte[b] for b in data]
        if len(ids) > LEAF:
            return self._merge_heap(ids)
        get, none = self.ranks.get, self.no_rank
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i : i + 2] = [self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
        return ids

    def _merge_heap(self, ids: list[int]) -> list[int]:
        n = len(ids)
        prev, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(self.ranks[p], i, p) for i in range(n - 1) if (p := ids[i] << 32 | ids[i + 1]) in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != pair:
                continue
            ids[i], ids[j] = self.made[self.ranks[pair]], -1
            after[i] = after[j]
            if after[j] < n:
                prev[after[j]] = i
            for a, b in ((prev[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := ids[a] << 32 | ids[b]) in self.ranks:
                    heapq.heappush(heap, (self.ranks[p], a, p))
        return [i for i in ids if i >= 0]

    def tree(self, data: bytes) -> list[int]:
        """One piece of any length."""
        if len(data) <= LEAF:
            return self.merge(data)
        middle = len(data) // 2
        return self.joined(self.tree(data[:middle]), self.tree(data[middle:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Encodings of two parts of one piece to the encoding of the piece."""
        size = 1
        while True:
            a, b = left[-size:], right[:size]
            new = self.merge(b"".join(map(self.bytes_of.__getitem__, a + b)))
            if (size >= len(left) or new[0] == a[0]) and (size >= len(right) or new[-1] == b[-1]):
                return left[: len(left) - len(a)] + new + right[len(b) :]
            size *= 2

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            if self.leaf and len(piece) <= LEAF // 4:
                found = tuple(self.leaf(piece))
            else:
                found = tuple(self.tree(piece.encode("utf-8", "replace")))
            if len(found) <= LEAF:
                self.known[piece] = found
        return found

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """(text between special tokens, id of the special token behind it or -1)."""
        start = 0
        for m in self.at_special.finditer(text):
            yield text[start : m.start()], self.special[m.group()]
            start = m.end()
        yield text[start:], -1

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, special in self.parts(text):
            out += chain.from_iterable(map(self.piece_ids, self.pieces.findall(part)))
            if special >= 0:
                out.append(special)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def joined_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """Pieces of two neighbouring chunks, each cut on its own, to the pieces of the joined text."""
        left, right = list(left), list(right)
        tail, size = "", 0
        while left and size < LOOK_AHEAD:
            tail = left.pop() + tail
            size = len(tail)
        while left and len(tail) < LOOK_AHEAD:
            tail = left.pop() + tail
        width = 16
        while True:
            head = "".join(right[:width])
            all_in = width >= len(right)
            ends = dict(zip(np.cumsum([len(p) for p in right[:width]]).tolist(), range(1, width + 1), strict=False)) | {0: 0}
            cut, at = [], 0
            for piece in self.pieces.findall(tail + head):
                if not all_in and at + len(piece) > len(tail) + len(head) - LOOK_AHEAD:
                    break
                cut.append(piece)
                at += len(piece)
                if at >= len(tail) and (n := ends.get(at - len(tail))) is not None and (n < width or all_in):
                    return left + cut + right[n:]
            if all_in:
                return left + cut
            width *= 2


def _encoded(rows: DataFrame, path: str, decoded: bool) -> DataFrame:
    """rows with ids and, if asked for, decoded; batches leave in slices of SLICE rows to bound a worker's memory."""

    def encode_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                ids = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
                columns = [*part.columns, pa.array([np.array(x, np.int32) for x in ids], pa.list_(pa.int32()))]
                names = [*part.schema.names, "ids"]
                if decoded:
                    columns.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        bpe.known.clear()  # the worker may serve other tasks next

    schema = T.StructType([*rows.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add("decoded", T.StringType())
    return rows.mapInArrow(encode_batches, schema)


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """docs with ids, the token ids of text, and with decoded, the text of these ids, if asked for.

    path names a tokenizer file that every executor has.
    """
    own = docs.drop("ids", "_row", "_at", "_part", *(["decoded"] if decoded else []))
    long_text = F.length(whole(F.col("text"))) > chunk
    short = _encoded(own.where(~long_text), path, decoded)
    long_rows = own.where(long_text).withColumn("_row", F.monotonically_increasing_id())
    leaves = long_rows.select("_row", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("_at", "_part"))
    kept = own.columns

    @F.pandas_udf("array<string>")
    def cut(parts: pd.Series) -> pd.Series:
        bpe = Bpe.load(path)
        out = []
        for part in parts:
            for piece in (pieces := bpe.pieces.findall(part)):
                bpe.piece_ids(piece)
            out.append(pieces)
        return pd.Series(out, dtype=object)

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bpe = Bpe.load(path)
        level = [list(p) for p in frame.sort_values("_at")["_pieces"]]
        if bpe.at_special.search("".join(chain.from_iterable(level))):
            ids = bpe.encode("".join(chain.from_iterable(level)))
        else:
            while len(level) > 1:
                level = [bpe.joined_pieces(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
            ids = list(chain.from_iterable(map(bpe.piece_ids, level[0])))
        return pd.DataFrame({"_row": [key[0]], "ids": [np.array(ids, np.int32)]})

    dealt = leaves.repartition("_row", "_at").select("_row", "_at", cut("_part").alias("_pieces"))
    whole_ids = dealt.groupBy("_row").applyInPandas(join, "_row long, ids array<int>")
    long = long_rows.join(whole_ids, "_row").select(*kept, "ids")
    return short.unionByName(decode(long, path) if decoded else long)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """rows with decoded, the text of their ids."""

    @F.pandas_udf("string")
    def decode_batch(ids: pd.Series) -> pd.Series:
        bpe = Bpe.load(path)
        return pd.Series(["" if x is None else bpe.decode(x.tolist()) for x in ids], dtype=object)

    return rows.withColumn("decoded", decode_batch("ids"))
