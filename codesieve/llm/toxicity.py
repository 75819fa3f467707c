"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

The kernel of two words sums, over all sequences of ORDER signs that both contain with at most
SPAN - ORDER other characters between them, the products of DECAY ** span; it is normalised by both words'
own kernels. Signs are letters and one mark before the first letter of the word. Inserted characters and
letters only widen a span, so "id-iot" and "idixot" stay near "idiot". Letters beyond U+0180 share the codes
of the others by their number; words of fewer than three letters have no sequence and score the bias.

Training, on at most `train_rows` labelled documents (a hash sample, all counts bounded by it):

0. Near copies of one text count once.
1. Spark counts in how many toxic and clean documents each run of 4 to 6 signs occurs; runs that are far
   commoner in toxic ones mark the words that make a sentence of a toxic document toxic.
2. Sentences of toxic documents with such words are the positive ones, represented by these words; words of
   sentences of clean documents are negative. Every word weighs as the share of its class's documents that hold it,
   so a word that clean documents hold now and then gets a smaller margin. Landmarks are drawn from both kinds, those of
   toxic sentences evenly over the runs; each word becomes K_mm ** -1/2 k(word, landmarks), and a linear SVM (squared
   hinge loss) is trained.
3. The clean words that score highest are added as negatives, variants of the commonest positive words
   with a letter put in as positives, and the machine is trained again, ROUNDS times.
4. A document's features are its most toxic word and the share and number of its words that score above zero;
   a logistic curve fitted on the same documents turns them into the score from 0 to 1.

Since k(word, landmark) is a sum over letter sequences, the machine is one weight per sequence: scoring a
text adds weights of its sequences word by word, in whole arrays, at most CHUNK characters of short texts together. A text
of any length is scored whole, by one task. Single letters in a row ("i d i o t") are read as one word.

Scores use the text alone. Nulls: a null text is empty and scores as a text without toxic words; labels
that are null, rows without id and ids that occur with both labels are not used for training. Without
both classes among the training rows every score is 0. Repeated rows are scored alike; an empty table gives no rows.
Columns of docs besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import stored, whole

ORDER, SPAN, DECAY = 4, 6, 0.6
GRAMS = (4, 5, 6)
TRAIN_ROWS = 15_000
#: Bounds of the training set, in words; all words of the sampled documents are counted before it is drawn.
POSITIVE_WORDS, NEGATIVE_WORDS, LANDMARKS = 4_000, 8_000, 400
HARD_WORDS, ROUNDS, GAPPED_WORDS = 2_000, 3, 60
#: A run marks words if it is RATIO times as frequent in toxic documents, with this much evidence (log-likelihood).
RATIO, EVIDENCE = 4.0, 20.0
THRESHOLD = 0.7
START = 32
LETTERS = 33
CHUNK = 2 << 20
#: Index offsets of a sequence after its first letter, and its weight.
SHAPES = [((0, *rest), DECAY ** (rest[-1] + 1)) for rest in combinations(range(1, SPAN), ORDER - 1)]
SPACED = re.compile(r"(?<![^\s])(?:\w[\s.\-*_]{1,2}){3,}\w(?![^\s.,!?])")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _letters() -> np.ndarray:
    """Codes of characters below 0x180: letters 1-26, accented ones 27-31, digits and signs the letters they mimic, 0 others."""
    import unicodedata

    groups = {"e": 27, "a": 28, "o": 29, "u": 30}
    out = np.zeros(0x180, np.int64)
    for c in range(0x180):
        base = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        if "a" <= base <= "z":
            out[c] = ord(base) - 96 if c < 128 else groups.get(base, 31)
    for sign, letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}.items():
        out[ord(sign)] = ord(letter) - 96
    out[0xDF] = 31
    return out


CODES = _letters()


@dataclass
class Machine:
    """Weights per letter sequence (LETTERS ** ORDER of them), and the logistic curve over the features."""

    weights: np.ndarray
    bias: float
    slopes: tuple[float, ...] | list[float] = (1.0, 1.0, 1.0)
    offset: float = 0.0


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    signs = ((points >= 0x2000) & (points < 0x2C00)) | ((points >= 0x3000) & (points < 0x3040))
    beyond = np.where(signs, 0, points % 26 + 1)
    return np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], beyond).astype(np.int64)


def _marked(text: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, word number) of each position; the sign before a word's first letter is START. Words start behind a space."""
    codes = _codes(text)
    number = np.repeat(np.arange(len(starts) + 1), np.diff(np.r_[0, starts - 1, len(text)])) - 1
    letters = np.flatnonzero(codes)
    letters = letters[number[letters] >= 0]
    first = np.r_[True, np.diff(number[letters]) > 0] if len(letters) else np.empty(0, bool)
    codes[letters[first] - 1] = START
    return codes, number


def joined_letters(text: str) -> str:
    """Runs of four or more single letters become one word."""
    return SPACED.sub(lambda m: re.sub(r"[\s.\-*_]", "", m.group()), text)


def sequences(codes: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(start positions, sequence keys, weight) for every shape; sequences stay in one word and hold letters only."""
    n = len(codes)
    for shape, weight in SHAPES:
        reach = shape[-1]
        if n <= reach:
            continue
        ok = word[: n - reach] == word[reach:]
        key = np.zeros(n - reach, np.int64)
        for k in shape:
            part = codes[k : n - reach + k]
            ok &= part > 0
            key = key * LETTERS + part
        at = np.flatnonzero(ok)
        yield at, key[at], weight


def _vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, sequence key, weight): each word's sequences with summed weights, of norm 1."""
    starts = np.cumsum([1, *(len(w) + 1 for w in words)])[:-1]
    codes, number = _marked(" " + " ".join(words), starts)
    parts = [(number[at], key, np.full(len(at), w)) for at, key, w in sequences(codes, number)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    rows, keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    both, at = np.unique(rows * LETTERS**ORDER + keys, return_inverse=True)
    values = np.bincount(at, values)
    rows, keys = both // LETTERS**ORDER, both % LETTERS**ORDER
    norm = np.sqrt(np.bincount(rows, values**2, len(words)))
    return rows, keys, values / np.maximum(norm[rows], 1e-12)


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernels, words x landmarks."""
    rows, keys, values = _vectors(landmarks)
    used, at = np.unique(keys, return_inverse=True)
    dense = np.zeros((len(used) + 1, len(landmarks)))
    dense[at, rows] = values
    out = np.zeros((len(words), len(landmarks)))
    for start in range(0, len(words), 250):  # bounds the products held at once
        r, k, v = _vectors(words[start : start + 250])
        where = np.minimum(np.searchsorted(used, k), len(used) - 1) if len(used) else np.zeros(len(k), int)
        hit = used[where] == k if len(used) else np.zeros(len(k), bool)
        r, at = np.unique(r[hit], return_index=True)  # rows come in order
        if len(r):
            out[start + r] = np.add.reduceat(v[hit, None] * dense[where[hit]], at)
    return out


def _svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, steps: int = 60) -> np.ndarray:
    """Linear SVM with squared hinge loss, each row's loss times its share, by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        active = y * (x @ w) < 1
        near = x[active]
        pull = near.T @ (share[active] * y[active])
        near *= np.sqrt(share[active])[:, None]
        new = np.linalg.solve(np.eye(x.shape[1]) + near.T @ near, pull)
        if np.abs(new - w).max() < 1e-8:
            return new
        w = new
    return w


def gapped(words: list[str], each: int = 3) -> list[str]:
    """Variants of words with one letter put in, at random places behind the first letter."""
    rng = np.random.default_rng(9)
    out = []
    for word in words:
        for _ in range(each if len(word) > ORDER else 0):
            at, letter = int(rng.integers(1, len(word))), chr(97 + int(rng.integers(26)))
            out.append(word[:at] + letter + word[at:])
    return out


def spread(words: dict[str, float], marks: set[str], n: int) -> list[str]:
    """n of the words, evenly over the runs that mark them, heaviest first."""
    kinds: dict[str, list[str]] = {}
    for word in sorted(words, key=lambda w: (-words[w], w)):
        kinds.setdefault(next((g for g in runs(word) if g in marks), ""), []).append(word)
    turns = sorted((i, -words[w], w) for own in kinds.values() for i, w in enumerate(own))
    return [w for _, _, w in turns[:n]]


def fit(positive: dict[str, float], negative: dict[str, float], marks: set[str], n_landmarks: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """(weight per letter sequence, bias) of the machine, from words with the weights of their losses."""
    rng = np.random.default_rng(5)
    half = n_landmarks // 2
    clean = list(negative)
    landmarks = spread(positive, marks, half) + [clean[i] for i in rng.permutation(len(clean))[:half]]
    rows, keys, values = _vectors(landmarks)
    landmarks = [landmarks[i] for i in np.unique(rows)]
    values_, vectors = np.linalg.eigh(_kernel(landmarks, landmarks))
    root = vectors[:, keep := values_ > 1e-6] / np.sqrt(values_[keep])
    words = [*positive, *negative]
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    w = _svm(_kernel(words, landmarks) @ root, y, np.array([*positive.values(), *negative.values()]))
    beta = root @ w[:-1]
    weights = np.zeros(LETTERS**ORDER)
    rows, keys, values = _vectors(landmarks)
    np.add.at(weights, keys, values * beta[rows])
    return weights.astype(np.float32), float(w[-1])


def word_scores(text: str, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """(starts of words, decision value of each)."""
    text = " " + text
    spans = [m.span() for m in WORDS.finditer(text)]
    starts = np.array([a for a, _ in spans], np.int64)
    if not spans:
        return starts, np.empty(0)
    scores = _decide(*_marked(text, starts), starts, weights) + bias
    near = np.flatnonzero(scores > 0)
    if len(near):  # exact norms, in which repeated sequences of a word count together
        rows, keys, values = _vectors([text[slice(*spans[i])] for i in near])
        scores[near] = np.bincount(rows, values * weights[keys], len(near)) + bias
    return starts - 1, scores


def _decide(codes: np.ndarray, number: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per word the sum of its sequences' weights over the norm its vector has if no sequence repeats: a bound if positive."""
    total, norm = np.zeros(len(codes)), np.zeros(len(codes))
    for at, key, w in sequences(codes, number):
        total[at] += w * weights[key]
        norm[at] += w * w
    sums, norms = np.add.reduceat(total, starts - 1), np.add.reduceat(norm, starts - 1)
    return sums / np.sqrt(np.maximum(norms, 1e-12))


def _clean(text: str | None) -> str:
    return joined_letters(text.lower() if text else "")


def runs(word: str) -> list[str]:
    """Runs of GRAMS letters of the word, the mark "^" before it counted as one."""
    marked = "^" + word.strip(".,;:!?")
    every = (marked[i : i + k] for k in GRAMS for i in range(len(marked) - k + 1))
    return [g for g in every if g.lstrip("^").isalpha()]


def features(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Each text's largest word score within -1 and 1 (beyond the margins all are alike), its share of words above 0, and their number.

    Share and number are logarithms, drawn towards those of a short text without such words.
    """
    best, hits, n = np.full(len(texts), -1.0), np.zeros(len(texts)), np.zeros(len(texts))
    sizes = np.cumsum([len(t) + 1 for t in texts]) // CHUNK
    for chunk in np.unique(sizes):
        own = np.flatnonzero(sizes == chunk)
        starts, scores = word_scores("\n".join(texts[i] for i in own), weights, bias)
        if len(starts):
            ends = np.cumsum([len(texts[i]) + 1 for i in own])
            doc = own[np.searchsorted(ends, starts, side="right")]
            np.maximum.at(best, doc, scores)
            hits += np.bincount(doc, scores > 0, len(texts))
            n += np.bincount(doc, minlength=len(texts))
    return np.c_[np.clip(best, -1.0, 1.0), np.log((hits + 0.3) / (n + 30)), np.log(hits + 0.3)]


def _gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, n_toxic, n_clean): documents of each kind that have a word with this run of letters."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(toxic)].update({g for w in set(WORDS.findall(_clean(text))) for g in runs(w)})
            every = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"gram": every, "n_toxic": [seen[1][g] for g in every], "n_clean": [seen[0][g] for g in every]})

    parts = rows.mapInPandas(count, "gram string, n_toxic long, n_clean long")
    return parts.groupBy("gram").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def _words(rows: DataFrame, grams: set[str]) -> DataFrame:
    """(word, toxic, marked, n): marked words of toxic documents' sentences, all words of clean ones; n counts documents."""

    def words(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                for w in {w.strip(".,;:!?") for w in WORDS.findall(_clean(text))}:
                    marked = not grams.isdisjoint(runs(w))
                    if len(w) >= ORDER - 1 and (marked or not toxic):
                        found[w, int(toxic), marked] += 1
            yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["word", "toxic", "marked", "n"])

    parts = rows.mapInPandas(words, "word string, toxic int, marked boolean, n long")
    return parts.groupBy("word", "toxic", "marked").agg(F.sum("n").alias("n"))


def _hardest(rows: DataFrame, weights: np.ndarray, bias: float, n: int) -> DataFrame:
    """The n rows (word, n) of clean documents whose words have the highest scores."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=word_scores(" ".join(batch["word"]), shared.value, bias)[1])

    scored = rows.select("word", "n").mapInPandas(score, "word string, n long, score double")
    return scored.orderBy(F.desc("score"), "word").limit(n)


def _logistic(s: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """slopes and offset of P(toxic) = 1 / (1 + exp(-(slopes @ s + offset))), classes balanced, lightly held back."""
    x = np.c_[s, np.ones(len(s))]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w, held = np.zeros(x.shape[1]), np.r_[np.full(s.shape[1], 0.002), 0.0] * len(y)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(held) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (share * (y - p)) - held * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w[:-1]], float(w[-1])


def without_copies(rows: DataFrame) -> DataFrame:
    """rows with nearly all near copies of one label left out, so that their words do not count as evidence many times.

    Texts with the smallest hash of two neighbouring words in common are taken as copies, then those with the largest.
    """
    words = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    for pick in (F.array_min, F.array_max):
        first = rows.select("toxic", "doc_id", pick(pairs).alias("_sign")).groupBy("toxic", "_sign").agg(F.min("doc_id").alias("doc_id"))
        rows = rows.join(F.broadcast(first.select("doc_id").distinct()), "doc_id", "left_semi")  # at most train_rows ids
    return rows


def train(rows: DataFrame, cost: float = 30.0, clean_weight: float = 5.0) -> Machine | None:
    """rows: doc_id, text, toxic (0 or 1) that may be learned from. None without both classes.

    A toxic document's word costs `cost`, a clean one's clean_weight times as much at equal shares of documents:
    a text has hundreds of them.
    """
    rows = stored(without_copies(stored(rows)))
    classes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = classes.get(1, 0), classes.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    t, usual = F.col("n_toxic"), (F.col("n_clean") + 0.5) * (n_toxic / n_clean)
    worth = t * F.log(t / usual) - (t - usual)
    grams = _gram_counts(rows).where((t >= 2) & (t > RATIO * usual) & (worth > min(EVIDENCE, n_toxic / 10))).select("gram")
    marked = {r["gram"] for r in grams.collect()}
    words = stored(_words(rows, marked))
    clean = words.where("toxic = 0")
    share = cost * clean_weight * n_toxic / n_clean
    best = words.where("toxic = 1").orderBy(F.desc("n"), F.xxhash64("word"), "word").limit(POSITIVE_WORDS)
    positive = {r["word"]: cost * r["n"] for r in best.collect()}
    drawn = clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVE_WORDS)
    near = clean.where("marked").orderBy(F.desc("n"), F.xxhash64("word"), "word").limit(POSITIVE_WORDS)
    negative = {r["word"]: share * r["n"] for r in drawn.union(near).collect()}
    if not positive or not negative:
        return None
    weights, bias = fit(positive, negative, marked)
    variants = dict.fromkeys(gapped([w for w in positive if w.isalpha()][:GAPPED_WORDS]), cost)
    known = {w: v for w, v in variants.items() if w not in positive}
    for _ in range(ROUNDS):
        negative |= {r["word"]: share * r["n"] for r in _hardest(clean, weights, bias, HARD_WORDS).collect()}
        weights, bias = fit({**positive, **{w: v for w, v in known.items() if w not in negative}}, negative, marked)
    raw = scored(rows, Machine(weights, bias), "decision").select("decision", "toxic").toPandas()
    return Machine(weights, bias, *_logistic(np.array(raw["decision"].tolist()), raw["toxic"].to_numpy()))


def scored(docs: DataFrame, machine: Machine | None, raw: str | None = None) -> DataFrame:
    """docs with score, or with the features under the given name."""
    if machine is None:
        return docs.withColumn(raw or "score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("array<double>" if raw else "double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        found = features([_clean(t) for t in texts], m.weights, m.bias)
        return pd.Series(list(found)) if raw else pd.Series(1 / (1 + np.exp(-(found @ np.array(m.slopes) + m.offset))))

    return docs.withColumn(raw or "score", score(whole(F.col("text"))))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, toxic of at most train_rows labelled documents that are not held out."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(fold(F.col("doc_id")) != 1)
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).where("toxic = _most")
    sample = known.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")


def score_documents(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    machine = train(training_rows(docs, labels, train_rows))
    rows = scored(docs.select("doc_id", "text"), machine)
    return rows.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
