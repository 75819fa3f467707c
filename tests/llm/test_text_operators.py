"""Operators on texts against plain Python."""

import hashlib
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codesieve.llm import bpe_tree, license_scan, line_dedup, ngram_join, ngram_quality, suffix_dedup, temperature_mix
from codesieve.llm.queries import tokenizer_path


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# Line dedup


def plain_lines(rows):
    first = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n") if doc_id is not None else []:
            if len(k := line_dedup.line_key(line)) >= 10:
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(k := line_dedup.line_key(x)) < 10 or first[k] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_lines(docs, rows, no_docs, clashing):
    columns = ("doc_id", "n_lines", "n_dropped", "kept")
    assert Counter(collected(line_dedup.dedup_lines(docs), *columns)) == plain_lines(rows)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert Counter(collected(line_dedup.dedup_lines(clashing), *columns)) == plain_lines(rows[:40])


def test_line_store_is_reversible(docs, rows):
    some = docs.where("doc_id % 3 = 0")
    rest = docs.where("doc_id % 3 <> 0")
    store = line_dedup.insert(line_dedup.build(rest), some)
    both = line_dedup.apply_drops(docs, line_dedup.dropped_keys(store))
    assert Counter(collected(both, "doc_id", "n_lines", "n_dropped", "kept")) == plain_lines(rows)
    back = line_dedup.remove(store, some.select("doc_id"))
    left = [r for r in rows if r[0] is None or r[0] % 3]
    out = line_dedup.apply_drops(docs.where("doc_id is null or doc_id % 3 <> 0"), line_dedup.dropped_keys(back))
    assert Counter(collected(out, "doc_id", "n_lines", "n_dropped", "kept")) == plain_lines(left)


def test_store_grows_a_thousandfold(spark):
    """Inserts beyond the size of the filters, and back."""
    small = spark.createDataFrame([(1, "a line that stands here\nown line of one"), (2, "a line that stands here")], "doc_id long, text string")
    lines = "\n".join(f"line number {i} of many" for i in range(5001))
    more = spark.createDataFrame([(3, lines + "\nown line of one"), (4, lines)], "doc_id long, text string")
    store = line_dedup.insert(line_dedup.build(small), more)
    both = small.unionByName(more)
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.apply_drops(both, line_dedup.dropped_keys(store)).collect()}
    assert found == {1: (2, 0), 2: (1, 1), 3: (5002, 1), 4: (5001, 5001)}
    assert store.filters.count() == store.filters.select("shard").distinct().count() and store.filters.where("blob is null").isEmpty()
    back = line_dedup.remove(store, more.select("doc_id"))
    assert line_dedup.dropped_keys(back).select("doc_id").collect() == [(2,)]
    again = line_dedup.insert(back, more.withColumn("doc_id", F.col("doc_id") + 10))
    assert {r["doc_id"] for r in line_dedup.dropped_keys(again).collect()} == {2, 13, 14}


def test_cuckoo_filter():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**62), 2**62, 20_000)
    f = line_dedup.CuckooFilter(len(keys))
    assert f.insert(keys)
    assert f.contains(keys).all()
    assert f.contains(rng.integers(-(2**62), 2**62, 20_000)).mean() < 0.01
    f = line_dedup.CuckooFilter.load(f.dump())
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all()
    assert f.contains(keys[:10_000]).mean() < 0.01


# N-gram Jaccard join


def plain_classes(rows, k, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
        if doc_id is not None:
            sets[doc_id] = grams
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 55)])
def test_classes(docs, rows, no_docs, k, percent):
    found = collected(ngram_join.jaccard_classes(docs, k, percent), "doc_id", "n_shingles", "component_id")
    assert len(found) == len(rows)
    assert (None, 0, None) in found
    assert {i: (n, c) for i, n, c in found if i is not None} == plain_classes(rows, k, percent)
    assert ngram_join.jaccard_classes(no_docs, k, percent).count() == 0


def test_merge_skip_and_probe():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(0, 30))).tolist() for _ in range(rng.integers(1, 8))]
        least = int(rng.integers(1, 5))
        counts = Counter(int(x) for own in lists for x in own)
        assert ngram_join.merge_skip(lists, least) == sorted((x, n) for x, n in counts.items() if n >= least)
        a, b = (np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(2))
        share = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        assert ngram_join.probe(a, b, 60) == (100 * share[0] >= 60 * share[1])


# BPE


def test_bpe_equals_the_library(docs, rows, no_docs, clashing):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    real = Tokenizer.from_file(path)
    odd = ["", "a  b", "x<|endoftext|>y <|endoftext|>", "  \n\n  é漢😀\x1c\x85  '", "ab" * 700 + "-" * 300, "'re'lll 12²3"]
    extra = docs.sparkSession.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(extra)
    for chunk in (bpe_tree.CHUNK, 7):
        for text, ids, decoded in collected(bpe_tree.encode(every, path, chunk, decoded=True), "text", "ids", "decoded"):
            true = real.encode(text or "", add_special_tokens=False).ids
            assert ids == true
            assert decoded == real.decode(true, skip_special_tokens=False) == (text or "")
    assert bpe_tree.encode(no_docs, path).count() == 0
    assert bpe_tree.encode(clashing, path).count() == clashing.count()


# License scan


def test_licenses(spark, no_docs):
    texts = {
        1: "Code.\nLICENSED under the Apache License, version 2.0!\nmore",
        2: "This is the General\nPublic  License; all rights-reserved. General Public License",
        3: None,
        4: "",
        5: "licensed cc, by nc",
        6: "accc by, ccc byé cc byx",
        7: "the work is of no license",
    }
    docs = spark.createDataFrame([*texts.items(), (1, texts[1]), (None, "cc by")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert license_scan.scan(docs).count() == 9
    assert (found[1]["labels"], found[1]["n_base"], found[1]["score"]) == ("apache-2.0", 0, 1.0)
    assert (found[2]["base_labels"], found[2]["n_base"], found[2]["first_word"], found[2]["last_word"]) == ("gpl,reserved", 3, 3, 9)
    assert (found[3]["n_words"], found[3]["first_word"], found[3]["labels"]) == (0, None, "")
    assert found[5]["labels"] == "cc-by" or "cc-by" in found[5]["labels"].split(",")
    assert (found[6]["n_base"], found[7]["labels"]) == (0, "")
    assert found[None]["base_labels"] == "cc-by"
    assert license_scan.scan(no_docs).count() == 0


def plain_licenses(text, templates=None, threshold=None):
    """Labels and best containment of all blocks of all templates."""
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", text.translate({c: c + 32 for c in range(65, 91)}))
    hits = []
    for label, t in templates or license_scan.TEMPLATES:
        n, own = license_scan.word_count(t), set(license_scan.template_words(t))
        for s in range(0, len(words), n):
            shared = len(own & set(words[s : s + 2 * n]))
            if shared >= license_scan.required(len(own), threshold or license_scan.THRESHOLD):
                hits.append((label, shared / len(own)))
    return {label for label, _ in hits}, max((part for _, part in hits), default=0.0)


@pytest.mark.parametrize("segment", [license_scan.SEGMENT, 1])
def test_license_join_equals_all_blocks(spark, monkeypatch, segment):
    import random

    monkeypatch.setattr(license_scan, "SEGMENT", segment)  # at least the longest template
    rng = random.Random(4)
    every = [w for _, t in license_scan.TEMPLATES for w in t.split()]
    texts = []
    for k in range(150):
        words = [rng.choice(every + ["other"] * 20) for _ in range(rng.randint(0, 250))]
        for _ in range(rng.randint(0, 3)):
            notice = rng.choice(license_scan.TEMPLATES)[1].split()
            at = rng.randint(0, len(words))
            words[at:at] = [w for w in notice if rng.random() < 0.85]
        texts.append("".join(w + rng.choice([" ", "\n# ", ", "]) for w in words))
    texts += [texts[0], "word " * 50_000 + license_scan.TEMPLATES[1][1]]
    rows = [(n % 120, t, "own", "own") for n, t in enumerate(texts)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string, segments string").repartition(4)).collect()
    true = Counter()
    for n, t, *_ in rows:
        labels, part = plain_licenses(t)
        base = {label for phrase, label in license_scan.PHRASES.items() if re.search(rf"(?<![0-9a-z]){phrase.replace(' ', '[^0-9a-z]+')}(?![0-9a-z])", t.lower())}
        true[n, ",".join(sorted(labels | base)), 1.0 if base else part] += 1
    assert Counter((r["doc_id"], r["labels"], r["score"]) for r in found) == true
    assert sum(n for (_, labels, _), n in true.items() if labels) > 50


def test_words_far_apart_are_no_license(spark):
    filler = " the album of songs and a story of the road that people know " * 8
    texts = [
        "released" + filler + "under the" + filler + "mit" + filler + "a driving license",
        "The work of this farm is hard and it goes on and on until late at night, and it is not public but" + filler + "dedicated to a wide domain",
    ]
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["labels"], r["score"]) for r in found} == {("", 0.0)}


@pytest.mark.parametrize(("width", "prefix"), [(30, ""), (60, "# "), (40, " * ")])
def test_wrapped_licenses(spark, width, prefix):
    import textwrap

    texts = ["code\n" + "\n".join(prefix + x for x in textwrap.wrap(t, width)) + "\nmore" for _, t in license_scan.TEMPLATES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for i, (label, _) in enumerate(license_scan.TEMPLATES):
        assert label in found[i]["labels"].split(",")
        assert found[i]["score"] == 1.0


# Temperature mixing


def test_mix(docs, rows, no_docs):
    order, plan = temperature_mix.mix(docs, max_repeats=2.0)
    taken = collected(order, "doc_id", "source", "epoch", "n_tokens", "ahead")
    plans = {r["source"]: r for r in plan.collect()}
    largest = max(plans.values(), key=lambda r: r["total"])
    assert {r[0] for r in taken} == {r[0] for r in rows}
    for source, p in plans.items():
        tokens = sum(r[3] for r in taken if r[1] == source)
        assert p["budget"] <= tokens <= p["budget"] + max(r[3] for r in taken)
        assert p["budget"] / p["total"] <= 2.001
    assert largest["budget"] == largest["total"]
    assert max(p["budget"] / p["total"] for p in plans.values()) > 1.99
    assert temperature_mix.mix(no_docs)[0].count() == 0


def test_mix_to_entropy_and_budget(docs):
    import math

    _, plan = temperature_mix.mix(docs, target_entropy=1.3)
    w = [r["weight"] for r in plan.collect() if r["weight"]]
    assert abs(-sum(x * math.log(x) for x in w) - 1.3) < 1e-6
    order, plan = temperature_mix.mix(docs, target_entropy=1.3, budget=500)
    assert abs(sum(r["budget"] for r in plan.collect()) - 500) <= len(w)
    few = {(r[0], r[1]) for r in collected(order, "doc_id", "epoch")}
    again = {(r[0], r[1]) for r in collected(temperature_mix.mix(docs, target_entropy=1.3, budget=500)[0], "doc_id", "epoch")}
    assert few == again


# Suffix dedup


def plain_repeats(rows):
    ordered = sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda r: r[0])
    seen, out = {}, {}
    for doc_id, text in ordered:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                mark[i : i + 100] = b"\1" * 100
            seen[raw[i : i + 100]] = True
        out[doc_id] = len(raw), sum(mark), len(re.findall(b"\1+", bytes(mark))), bytes(x for x, m in zip(raw, mark, strict=True) if not m)
    return out


@pytest.mark.parametrize("group_size", [suffix_dedup.GROUP, 3])
def test_repeats(docs, rows, no_docs, group_size):
    found = collected(suffix_dedup.remove_repeats(docs, group_size), "doc_id", "n_bytes", "n_removed", F.size("runs"), "kept")
    assert len(found) == len(rows)
    assert {r[0]: (*r[1:4], bytes(r[4])) for r in found if r[0] is not None} == plain_repeats(rows)
    assert [r[2] for r in found if r[0] is None] == [0]
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_deep_shallow_sort():
    import random

    import numpy as np

    rng = random.Random(4)
    base = ["".join(rng.choice("ab") for _ in range(30)) * 5 for _ in range(3)]
    texts = [b[:k] + rng.choice("xyz") + b[k:] for b in base for k in range(0, 120, 7)] * 2 + base
    raw = "".join(t[:110].ljust(110, "q") for t in texts).encode() + b"\0" * 100
    at = np.arange(len(texts)) * 110
    group = np.array([rng.randrange(2) for _ in texts])
    sets = suffix_dedup.sorted_groups(np.frombuffer(raw, np.uint8), at, group)
    keys = [(g, raw[a : a + 100]) for a, g in zip(at, group, strict=True)]
    count = Counter(keys)
    assert [s >= 0 for s in sets] == [count[k] > 1 for k in keys]
    assert len({(s, k) for s, k in zip(sets, keys, strict=True) if s >= 0}) == len({s for s in sets if s >= 0}) == sum(n > 1 for n in count.values())


# Quality rules


def plain_base(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def test_quality(docs, rows, no_docs, clashing):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = collected(ngram_quality.judged_table(docs), *names)
    true = Counter((r[0], *(b := plain_base(r[1])), b[0] < 20 or 100 * b[4] > 30 * b[0]) for r in rows)
    assert Counter(r[:7] for r in found) == true
    assert all(not kept for *_, failed, kept in found if failed)
    kept = ngram_quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r[0] for r in collected(kept, "doc_id")) == Counter(r[0] for r in found if r[7])
    assert ngram_quality.keep_good(no_docs).count() == 0
    own = ngram_quality.keep_good(clashing)
    assert own.columns == clashing.columns
    assert {r["quality"] for r in own.collect()} <= {"own"}


def plain_surprises(rows):
    """Mean surprise per 4-gram of every row by a dictionary model per language, over (id, text, lang) rows."""
    import math
    import struct

    def grams(text):
        raw = (text or "").encode("utf-16-le", "surrogatepass")
        units = (32, 32, 32, *struct.unpack(f"<{len(raw) // 2}H", raw))
        return [units[i : i + 4] for i in range(len(units) - 3)] if raw else []

    out = []
    own = [(lang or "", grams(text)) for _, text, lang in rows]
    models = {}
    for lang in {x for x, _ in own}:
        levels = {4: Counter(g for x, gs in own if x == lang for g in gs)}
        for k in (3, 2, 1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        prob = {(): 1 / 65536}
        for k in (1, 2, 3, 4):
            met = {i: max(1, sum(c == i for c in levels[k].values())) for i in (1, 2, 3, 4)}
            y = met[1] / (met[1] + 2 * met[2])
            d = {i: min(max(i - (i + 1) * y * met[i + 1] / met[i], 0.05), float(i)) for i in (1, 2, 3)}
            total, left = Counter(), Counter()
            for g, c in levels[k].items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3)]
            prob |= {g: (c - d[min(c, 3)]) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * prob[g[1:]] for g, c in levels[k].items()}
        size = sum(levels[4].values())
        models[lang] = {g: -math.log(total[g[:-1]] / size) - math.log(prob[g]) for g in levels[4]}
    for lang, gs in own:
        out.append(sum(models[lang][g] for g in gs) / len(gs) if gs else None)
    return out


def plain_kept(rows):
    """Whether each (id, text, lang, ...) row is kept: by the base rules and the band of its language."""
    import numpy as np

    surprises = plain_surprises([r[:3] for r in rows])
    bands = {}
    for lang in {r[2] or "" for r in rows}:
        own = [np.floor(s * 1000 + 0.5) for s, r in zip(surprises, rows, strict=True) if (r[2] or "") == lang and s is not None]
        if own:
            low, middle, high = np.quantile(own, [0.25, 0.5, 0.75])
            spread = max((high - low) / 2000, ngram_quality.LEAST_SPREAD)
            bands[lang] = middle / 1000 - ngram_quality.LOW * spread, middle / 1000 + ngram_quality.HIGH * spread
    out = []
    for r, s in zip(rows, surprises, strict=True):
        b = plain_base(r[1])
        root = max(b[0], 1) ** 0.5
        lowest, highest = bands.get(r[2] or "", (0, 0))
        inside = s is None or lowest - ngram_quality.LOW_SLACK / root <= s <= highest + ngram_quality.HIGH_SLACK / root
        out.append(inside and b[0] >= 20 and 100 * b[4] <= 30 * b[0])
    return out


@pytest.mark.parametrize("part", [ngram_quality.PART, 700])
def test_band_equals_plain(spark, rows, docs, clashing, monkeypatch, part):
    strange = [(1000 + i, t * 30, x) for i, t in enumerate(["QXZ %% ", "a ", "\U0001f600 und ", "word | ", "ab\ud800c "][:4]) for x in ("en", None)]
    every = [r[:3] for r in rows] + strange
    table = spark.createDataFrame(every, "doc_id long, text string, lang string").repartition(4)
    model = ngram_quality.train(table)
    scored = ngram_quality.scored(table, model, part)
    found = Counter((r["doc_id"], r["text"], r["lang"], r["kept"]) for r in ngram_quality.verdicts(scored, ngram_quality.bands(scored)).collect())
    assert found == Counter((*r, k) for r, k in zip(every, plain_kept(every), strict=True))
    assert 0 < sum(n for (*_, k), n in found.items() if not k) < len(every)


def test_texts_are_not_shuffled(spark, docs):
    plan = ngram_quality.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_language_model_is_a_distribution():
    import numpy as np

    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcd e")) for _ in range(4000))
    keys, n = np.unique(ngram_quality._own_keys([text])[0], return_counts=True)
    model = ngram_quality.estimate(keys, n)
    for context in (0, 1, 47, 45 * 45 * 2 + 3, 45**3 - 1):
        p = np.exp(ngram_quality.log_probability(model, context * ngram_quality.A + np.arange(ngram_quality.A)))
        assert abs(p.sum() - 1) < 1e-9
    assert all((np.diff(model[f"k{i}"]) > 0).all() for i in range(1, 5))


def test_junk_is_surprising(spark):
    import random

    rng = random.Random(1)
    words = ["the", "of", "and", "river", "stone", "people", "city", "water", "under", "light"]
    clean = [(i, "en", " ".join(rng.choice(words) for _ in range(120)) + ".") for i in range(200)]
    junk = [(900, "en", " ".join("".join(rng.choice("zqxjkvw#") for _ in range(9)) for _ in range(120)))]
    found = dict(collected(ngram_quality.judged_table(spark.createDataFrame(clean + junk, "doc_id long, lang string, text string")), "doc_id", "kept"))
    assert not found[900]
    assert sum(found[i] for i in range(200)) >= 198


def test_unfolded_model_over_tables(spark):
    import numpy as np

    texts = ["Der Baum AM Fluss, 漢字 и буквы.", "THE TREE!! %%% ***", "😀 the tree by the river", "и буквы"] * 3 + ["the tree"]
    docs = spark.createDataFrame([(i, "x", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    keys, n = np.unique(ngram_quality._own_keys(texts)[0], return_counts=True)
    one = ngram_quality.estimate(keys, n)
    share = {int(k): n[keys >> np.uint64(16) == k >> np.uint64(16)].sum() / n.sum() for k in keys}
    true = {int(k): np.log(share[int(k)]) + p for k, p in zip(keys, ngram_quality.log_probability(one, keys), strict=True)}
    table = ngram_quality.train(docs)
    found = {r["key"] % 2**64: r["logp"] for r in table.collect()}
    assert found.keys() == true.keys()
    assert all(abs(found[k] - true[k]) < 1e-9 for k in true)
    whole = dict(collected(ngram_quality.scored(docs, table), "doc_id", "quality.surprise"))
    parts = dict(collected(ngram_quality.scored(docs, table, part=25), "doc_id", "quality.surprise"))
    assert all(abs(whole[i] - parts[i]) < 1e-9 for i in range(len(texts)))
    own = [true[int(k)] for k in ngram_quality._own_keys([texts[0]])[0]]
    assert abs(whole[0] + np.mean(own)) < 1e-9


@pytest.mark.parametrize("kind", ["shouted", "symbols", "table", "greek"])
def test_kinds_of_junk_are_rejected(spark, kind):
    """Junk of words that clean documents use, in too small a share to be usual; in a script of its own as well."""
    import random

    rng = random.Random(2)
    ends = ["ing", "ed", "er", "tion", "ly", "s", "est", "ment"]
    words = [a + b for a in ["riv", "ston", "peopl", "cit", "wat", "und", "ligh", "gard", "wint", "hous"] for b in ends]
    if kind == "greek":
        words = [w.translate(str.maketrans("abcdefghilmnoprstuvwy", "αβκδεφγηιλμνοπρστυθωξ")) for w in words]
    clean = lambda: " ".join(rng.choice(words) for _ in range(120)) + "."
    spoil = {"shouted": str.upper, "symbols": lambda t: t.replace(" ", "%%% "), "table": lambda t: t.replace(" ", " | "), "greek": str.upper}[kind]
    rows = [(i, "x", clean()) for i in range(200)] + [(900 + i, "x", spoil(clean())) for i in range(8)]
    found = dict(collected(ngram_quality.judged_table(spark.createDataFrame(rows, "doc_id long, lang string, text string")), "doc_id", "kept"))
    assert not any(found[900 + i] for i in range(8))
    assert sum(found[i] for i in range(200)) >= 196


# Pipeline


def test_pipeline(spark, rows, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = [r for r, kept in zip(rows, plain_kept([(r[0], r[1], r[2]) for r in rows]), strict=True) if kept]
    assert Counter(r["doc_id"] for r in ngram_quality.keep_good(docs).collect()) == Counter(r[0] for r in good)
    lined = Counter({(i, text): n for (i, _, _, text), n in plain_lines(good).items()})
    classes = plain_classes([(i, text) for i, text in lined], 5, 80)
    left = Counter({(i, t): n for (i, t), n in lined.items() if i is None or classes[i][1] == i})
    from tokenizers import Tokenizer

    real = Tokenizer.from_file(tokenizer_path())
    true = {(i, tuple(real.encode(t, add_special_tokens=False).ids)) for i, t in left}
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect())
    assert set(found) == true
    assert max(found.values()) <= 2 * max(left.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "temperature_mix", "bpe"]


def test_stages_keep_clashing_columns(spark, clashing, no_docs):
    import corpus_pipeline

    docs = clashing.cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert {r["kept"] for r in out.collect()} == {"own"}
        assert stage(spark, no_docs, "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_kept_hash():
    assert line_dedup.sha256_hex("é") == hashlib.sha256("é".encode()).hexdigest()
    assert os.path.exists(tokenizer_path())
