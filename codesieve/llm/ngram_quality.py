"""Quality rules: base counts, and bands of n-gram perplexity per language.

The language model is a modified Kneser-Ney model of order 4 over UTF-16 units as they stand, so capitals, symbols
and letters of every script are told apart; one model per value of `lang`. Spark counts the 4-grams of all texts
(every task sums its batches, then one sum per language and key) and estimates the model as a table of n-gram
keys with log-probabilities, which grows with the corpus and is dealt by hash into parts of about PART n-grams. To score, a
pass over the texts per part looks n-grams up in the part's sorted arrays, which are broadcast, and adds what they
contribute to each text; nothing else is joined to a text. All scored texts were counted, so every n-gram is found.

A document's score is the log of its perplexity per n-gram, the mean negative log-probability of its n-grams, each as a
sequence of its own: that of the context, by its share of the language's text, times the smoothed conditional
probability of the last character after it. Junk is in the corpus that the model is counted on, so that after a few capitals
or symbols the next one is no surprise: the perplexity of last characters alone rejects half as much (README has both).
A language's band is `median - low * spread` to `median + high * spread`, where the median and spread (half the distance of
the quantiles 1/4 and 3/4, at least `least_spread`) are those of all its documents, read from a histogram of
scores rounded to 1/1000. Scores of short texts scatter more, so for a text of n words both sides widen by
`low_slack` and `high_slack` over the square root of n. The factors were chosen on the labelled documents of sf0.1
with even ids (README has what they lose and reject). Documents outside the band or that fail the base rules are rejected.

Nulls: a null text has no words (it fails the base rules); a null language is a language of its own.
Repeated rows count as often as they occur. Very long texts are scored whole, in slices of the batch. Empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesieve.functions.sizes import broadcast_if_small
from codesieve.llm.common import stored, whole

BITS = 16
A = 1 << BITS  # UTF-16 units
ORDER = 4
PART = 4_000_000
LOW, HIGH = 2.0, 3.0
LOW_SLACK, HIGH_SLACK = 3.0, 2.5
LEAST_SPREAD = 0.04
MIN_WORDS = 20
CHUNK = 1 << 20
MOST_LANGUAGES, LANGUAGE_BYTES = 100_000, 16 << 20  # what has a row per language is broadcast up to this size
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = T.StructType([T.StructField(c, T.LongType()) for c in NAMES])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-16 units of all texts, each behind ORDER - 1 spaces; where each text begins."""
    pad = b" \0" * (ORDER - 1)
    raw = [t.encode("utf-16-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"".join(pad + r for r in raw), np.uint16)
    starts = np.cumsum([0] + [len(r) // 2 + ORDER - 1 for r in raw])
    return codes, starts


def _keys(codes: np.ndarray) -> np.ndarray:
    """Key of the ORDER-gram that ends at each position; the first ORDER - 1 positions have none."""
    n = max(0, len(codes) - ORDER + 1)
    keys = np.zeros(n, np.uint64)
    for i in range(ORDER):
        keys <<= np.uint64(BITS)
        keys |= codes[i : n + i]
    return keys


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of about CHUNK characters each, so that a worker holds the words of one range at a time."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // CHUNK
    edges = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(part)] if len(part) else []
    return list(zip(edges, edges[1:], strict=False))


def _own_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys (unsigned) of the texts' own characters, and where each text's keys begin."""
    codes, starts = _codes(texts)
    keys = _keys(codes)
    ends = np.diff(starts) - (ORDER - 1)
    own = np.ones(len(codes), bool)
    for i in range(ORDER - 1):
        own[starts[:-1] + i] = False
    return keys[own[ORDER - 1 :]], np.cumsum(np.r_[0, ends])


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, key, n) over all characters of all texts; key holds the bits of the unsigned key."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for start, end in _slices(batch.column("text")):
                langs, texts = (batch.column(c).slice(start, end - start).to_pylist() for c in ("lang", "text"))
                for lang in set(langs):
                    own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                    seen.setdefault(lang, []).append(np.unique(_own_keys(own)[0], return_counts=True))
            for lang, parts in seen.items():
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

    texts = docs.select(whole(F.col("lang")).alias("lang"), "text").where("length(text) > 0")
    parts = texts.mapInArrow(count, "lang string, key long, n long")
    return parts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (max(1, int((counts == i).sum())) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([min(max(x, 0.05), i) if i else 0.0 for i, x in enumerate(d)])


def estimate(keys: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """The model of one language in memory (`train` is the same over tables): k{i}/p{i} n-grams and log-probabilities, c{i}/b{i} contexts and log back-offs."""
    order = np.argsort(keys)
    levels = [(keys[order].astype(np.uint64), n[order].astype(np.int64))]
    for i in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts the shorter n-gram stands
        levels.append(np.unique(levels[-1][0] % A**i, return_counts=True))
    model, lower = {}, None
    for i, (k, c) in enumerate(reversed(levels), 1):
        context, at = np.unique(k // A, return_inverse=True)
        total = np.bincount(at, c)
        d = _discounts(c)[np.minimum(c, 3)]
        back = np.bincount(at, d) / total
        below = np.full(len(k), 1 / A) if lower is None else np.exp(lower(k % A ** (i - 1)))
        model |= {f"k{i}": k, f"p{i}": np.log((c - d) / total[at] + back[at] * below), f"c{i}": context, f"b{i}": np.log(back)}
        lower = lambda q, i=i, m=model: log_probability(m, q, i)
    return model


def _find(sorted_keys: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, queries), len(sorted_keys) - 1)
    return at, sorted_keys[at] == queries


def log_probability(model: dict[str, np.ndarray], queries: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log P(last character | those before it), by back-off from the longest n-gram that is stored."""
    out = np.zeros(len(queries))
    open_ = np.arange(len(queries))
    queries = queries.astype(np.uint64)
    for i in range(order, 0, -1):
        q = queries[open_] if i == ORDER else queries[open_] % A**i
        at, hit = _find(model[f"k{i}"], q)
        out[open_[hit]] += model[f"p{i}"][at[hit]]
        open_, q = open_[~hit], q[~hit]
        at, hit = _find(model[f"c{i}"], q // A)
        out[open_[hit]] += model[f"b{i}"][at[hit]]
    out[open_] -= np.log(A)
    return out


def _per_language(rows: DataFrame) -> DataFrame:
    """A table of one small row per language, broadcast if it is measured to be small."""
    small = broadcast_if_small(rows, MOST_LANGUAGES, LANGUAGE_BYTES)
    return rows if small is None else small


def _smoothed(grams: DataFrame, below: DataFrame | None, order: int) -> DataFrame:
    """(lang, key, context_n, p): the probability of each n-gram's last character, by modified Kneser-Ney.

    A context has at most A followers, which bounds the windows whatever the size of the table; they come before the join
    by language, whose exchange would else serve them too and bring a language into one task.
    """
    met = [F.greatest(F.count_if(F.col("n") == i), F.lit(1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    found = grams.groupBy("lang").agg(*met)
    for i in (1, 2, 3):
        d = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        found = found.withColumn(f"d{i}", F.least(F.greatest(d, F.lit(0.05)), F.lit(float(i))))
    found = _per_language(found.select("lang", "d1", "d2", "d3"))
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    group = Window.partitionBy("lang", F.shiftrightunsigned("key", BITS))
    own = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)]
    rows = grams.select("*", F.sum("n").over(group).alias("context_n"), *[c.over(group).alias(f"m{i}") for i, c in enumerate(own, 1)])
    rows = rows.join(found, "lang").withColumn("d", d).withColumn("left", sum((F.col(f"m{i}") * F.col(f"d{i}") for i in (2, 3)), F.col("m1") * F.col("d1")))
    if below is None:
        rows = rows.withColumn("q", F.lit(1 / A))
    else:
        rows = rows.withColumn("suffix", F.col("key").bitwiseAND((1 << BITS * (order - 1)) - 1))
        rows = rows.join(below.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
    return rows.select("lang", "key", "context_n", ((F.col("n") - F.col("d")) / F.col("context_n") + F.col("left") / F.col("context_n") * F.col("q")).alias("p"))


def train(docs: DataFrame) -> DataFrame:
    """(lang, key, logp): log-probability of every n-gram of the texts, that of its context times that of its last character."""
    grams = stored(count_ngrams(docs))
    levels = [grams]
    for i in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts the shorter n-gram stands
        levels.append(levels[-1].groupBy("lang", F.col("key").bitwiseAND((1 << BITS * i) - 1).alias("key")).agg(F.count("*").alias("n")))
    below = None
    for i, level in enumerate(reversed(levels), 1):
        below = _smoothed(level, below, i)
    size = _per_language(grams.groupBy("lang").agg(F.sum("n").alias("size")))
    logp = F.log(F.col("context_n") / F.col("size")) + F.log("p")
    return stored(below.join(size, "lang").select("lang", "key", logp.alias("logp")))


def _arrays(model: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and their log-probabilities per language; model has at most about PART rows."""
    rows = model.toArrow()
    langs, keys, logp = rows["lang"].combine_chunks().dictionary_encode(), rows["key"].to_numpy(), rows["logp"].to_numpy()
    codes, out = langs.indices.to_numpy(), {}
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        at = np.flatnonzero(codes == i)
        at = at[np.argsort(keys[at])]
        out[lang] = keys[at], logp[at]
    return out


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0.0, np.cumsum(values)][starts])


def _repeat_words(hashes: np.ndarray, starts: np.ndarray, width: int = 8) -> np.ndarray:
    """Per text: its words inside windows of `width` words that the text has at least twice."""
    out = np.zeros(len(starts) - 1, np.int64)
    if len(hashes) < width:
        return out
    n = len(hashes) - width + 1
    win = np.zeros(n, np.uint64)
    for i in range(width):
        win = (win ^ (win >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : i + n]
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = doc[:n] == doc[width - 1 :]
    win = (win ^ (doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0x94D049BB133111EB)
    at = np.flatnonzero(inside)
    ordered = np.sort(win[at])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    _, hit = _find(twice, win[at])
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[hit], 1)
    np.add.at(cover, at[hit] + width, -1)
    words = np.cumsum(cover[:-1]) > 0
    return np.diff(np.r_[0, np.cumsum(words)][starts])


def _base(texts: list[str]) -> dict[str, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    words = [b.split() for b in raw]
    n_words = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(n_words.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)
    dup = []
    for b in raw:
        lines = [x for x in b.split(b"\n") if x.strip()]
        dup.append(len(lines) - len(set(lines)))
    columns = {
        "n_words": n_words,
        "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
        "n_dup_lines": dup,
        "n_repeat_words": _repeat_words(hashes, np.cumsum(np.r_[0, n_words])),
    }
    return {name: np.array(values, np.int64) for name, values in columns.items()}


def _log_sums(texts: list[str], langs: np.ndarray, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of the log-probabilities of its n-grams that the model holds, and its number of n-grams."""
    sums, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for x in set(langs):
        at = np.flatnonzero(langs == x)
        keys, starts = _own_keys([texts[i] for i in at])
        sizes[at] = np.diff(starts)
        if x in model:
            distinct, place = np.unique(keys, return_inverse=True)
            found, hit = _find(model[x][0], distinct.view(np.int64))
            sums[at] = _sums(np.where(hit, model[x][1][found], 0.0)[place], starts)
    return sums, sizes


def _log_sum(shared: Broadcast) -> Callable[..., Column]:
    @F.arrow_udf("double")
    def log_sum(texts: pa.Array, langs: pa.Array) -> pa.Array:
        parts = []
        for start, end in _slices(texts):
            own = [t or "" for t in texts.slice(start, end - start).to_pylist()]
            sums, sizes = _log_sums(own, np.array(langs.slice(start, end - start).to_pylist(), object), shared.value)
            parts.append(pa.array(sums / np.maximum(sizes, 1)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.float64())

    return log_sum


@F.arrow_udf(FEATURES)
def _base_counts(texts: pa.Array) -> pa.Array:
    parts = []
    for start, end in _slices(texts):
        out = _base([t or "" for t in texts.slice(start, end - start).to_pylist()])
        parts.append(pa.StructArray.from_arrays([pa.array(c) for c in out.values()], list(out)))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(c, pa.int64()) for c in NAMES]))


def scored(docs: DataFrame, model: DataFrame, part: int = PART, drop: tuple[str, ...] = ()) -> DataFrame:
    """docs with a struct column `quality`: the base counts and surprise (nats per n-gram, null if empty).

    The model is dealt by hash into parts of about `part` n-grams. Each is broadcast for a pass that adds its n-grams'
    share to the score of every text and writes the rows, so that texts are never shuffled or joined. The last pass
    leaves the columns `drop` out.
    """
    context = docs.sparkSession.sparkContext
    n_parts = -(-model.count() // part) or 1
    rows = docs.select("*", _base_counts("text").alias("_base"), F.lit(0.0).alias("_log"))
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    for i in range(n_parts):
        shared = context.broadcast(_arrays(model.where(F.pmod(F.hash("lang", "key"), F.lit(n_parts)) == i)))
        total = F.col("_log") + _log_sum(shared)(whole(F.col("text")), whole(F.col("lang")))
        if i + 1 < n_parts:
            rows = stored(rows.withColumn("_log", total))
        else:
            surprise = F.when(~empty, -total).alias("surprise")
            quality = F.struct(*[F.col(f"_base.{c}").alias(c) for c in NAMES], surprise).alias("quality")
            rows = stored(rows.select("*", quality).drop("_base", "_log", *drop))
        shared.destroy()
    return rows


def bands(rows: DataFrame, low: float = LOW, high: float = HIGH, least_spread: float = LEAST_SPREAD) -> DataFrame:
    """(band_lang, lowest, highest) from all rows' lang and quality.surprise: one small row per language."""
    step = F.round(F.col("quality.surprise") * 1000).cast("long")
    bins = rows.where("quality.surprise is not null and not isnan(quality.surprise)").groupBy(whole(F.col("lang")).alias("band_lang"), step.alias("bin")).agg(F.count("*").alias("n"))
    quantiles = bins.groupBy("band_lang").agg(F.percentile("bin", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"))
    spread = F.greatest((F.col("q")[2] - F.col("q")[0]) / 2000, F.lit(least_spread))
    return quantiles.select("band_lang", (F.col("q")[1] / 1000 - low * spread).alias("lowest"), (F.col("q")[1] / 1000 + high * spread).alias("highest"))


def verdicts(rows: DataFrame, limits: DataFrame, min_words: int = MIN_WORDS, low_slack: float = LOW_SLACK, high_slack: float = HIGH_SLACK) -> DataFrame:
    """rows of `scored` with base_failed, in_band and kept."""
    q = F.col("quality")
    failed = (q["n_words"] < min_words) | (100 * q["n_repeat_words"] > 30 * q["n_words"])
    root = F.sqrt(F.greatest(q["n_words"], F.lit(1)))
    inside = q["surprise"].between(F.col("lowest") - low_slack / root, F.col("highest") + high_slack / root)
    joined = rows.join(_per_language(limits), whole(rows["lang"]) == F.col("band_lang"), "left")
    judged = joined.withColumn("base_failed", failed).withColumn("in_band", F.coalesce(inside, F.lit(True)))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("in_band")).drop("band_lang", "lowest", "highest")


def judged_table(docs: DataFrame) -> DataFrame:
    """One row per row of docs, without its text: doc_id, lang, the base counts, surprise and the verdict."""
    rows = scored(docs.select("doc_id", "lang", "text"), train(docs), drop=("text",))
    return verdicts(rows, bands(rows)).select("doc_id", "lang", "quality.*", "base_failed", "in_band", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs whose verdict is to keep them, with the columns of docs. Each text is scored once."""
    own = docs.drop("quality", "base_failed", "in_band", "kept", "band_lang", "lowest", "highest", "_log", "_base")
    if set(own.columns) != set(docs.columns):
        return _renamed(docs)
    rows = scored(own, train(docs))
    return verdicts(rows, bands(rows)).where("kept").select(*docs.columns)


def _renamed(docs: DataFrame) -> DataFrame:
    """keep_good for tables that already have columns of the operator's names."""
    back = {f"_own{i}": c for i, c in enumerate(docs.columns)}
    safe = docs.toDF(*back).withColumnsRenamed({k: c for k, c in back.items() if c in ("text", "lang")})
    return keep_good(safe).toDF(*docs.columns)
