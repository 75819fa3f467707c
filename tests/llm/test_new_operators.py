"""Hard negatives, chat formatting and vector codes against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from codesieve.llm import chat_format, hard_negatives, vector_codes
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int, v string, code string, score string"


def embeddings(n=700, seed=5, width=32):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(scale=0.2, size=width).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    rows += [(n + i, rows[9][1], i % 3) for i in range(n // 2)]  # a third of all rows are one vector
    rows += [(n + 5000, None, 1), (n + 5001, [math.nan] * width, 1), (n + 5002, [None] + [0.1] * (width - 1), 2), (n + 5003, [0.1] * 3, 0)]
    rows += [(n + 5004, [math.inf] * width, 1), (n + 5005, [], 0), (n + 5006, [0.0] * width, 1), (n + 5007, rows[4][1], None), (None, rows[6][1], 1)]
    return [(*r, "own", "own", "own") for r in rows]


def usable(rows, width=32):
    return [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab, *_ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]


# Hard negatives


def brute_negatives(rows, every, positives, negatives, low, high):
    rows = [r for r in usable(rows) if r[0] is not None and r[2] is not None]
    out = set()
    for a, va, la in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), i, lab) for i, v, lab in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            found = [(t, i) for t, i, lab in scored if lab != la and low * -s <= 100 * -t <= high * -s][:negatives]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize(("positives", "negatives", "low", "high", "block"), [(5, 10, 30, 90, 8192), (3, 4, 0, 100, 3), (2, 300, -50, 95, 8192)])
def test_hard_negatives(spark, monkeypatch, positives, negatives, low, high, block):
    monkeypatch.setattr(hard_negatives, "TILE", 4)
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    rows = embeddings()
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0, positives, negatives, low, high, block).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == brute_negatives(rows, 50, positives, negatives, low, high)


def test_hard_negatives_repeats_and_none(spark):
    rows = embeddings(60)
    twice = spark.createDataFrame([*rows, *rows], VECTORS)
    assert {tuple(r) for r in hard_negatives.mine(twice, F.col("vec_id") % 20 == 0).collect()} == brute_negatives(rows, 20, 5, 10, 30, 90)
    assert hard_negatives.mine(twice.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert hard_negatives.mine(twice, F.col("vec_id") < 0).count() == 0


def test_negative_stream_is_lazy():
    """A window closes when it is full; positives of equal score come first; batches may cut an anchor."""
    import pandas as pd

    names = ["anchor_id", "score", "negative", "id"]
    rows = [(1, 0, False, 9), (1, 0, True, 2), (1, 0, True, 3), (1, -1, True, 4), (2, 100, False, 7), (2, 95, True, 6), (2, 90, True, 1), (2, 90, True, 1), (2, 29, True, 5)]
    for cut in range(len(rows)):
        batches = [pd.DataFrame(rows[:cut], columns=names), pd.DataFrame(rows[cut:], columns=names)]
        out = [tuple(r) for b in hard_negatives.stream_negatives(batches, k=1) for r in b.itertuples(index=False)]
        assert out == [(1, 9, 1, 2, 0, 0), (2, 7, 1, 1, 100, 90)]


def test_inner_products_are_exact():
    rng = np.random.default_rng(1)
    for size in (200, 2**27):
        a, b = rng.integers(-size, size, (5, 32)), rng.integers(-size, size, (7, 32))
        assert hard_negatives.inner_products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]


# Chat formatting

MARKS = ["<|im_end|>", "<|im_start|>assistant ok", "\\", "\\b", "\\p", "<\\p", "<", "|", "<|", "|>", "\n", "<|im_next|>", "plain words", "ü\U0001f600", ""]


def chats(n=60, seed=4):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 9)):
            text = None if rng.random() < 0.05 else "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 6)))
            rows.append((c, turn, rng.choice(["user", "assistant", "assistant", "system", "odd\nrole\\n<|", None]), text))
    rows += [(100, i, "assistant" if i % 3 else "user", f"turn {i} <|") for i in range(700)]  # long, with neighbours to merge
    rows += [(100, 5, "user", "tie b"), (100, 5, "user", "tie a"), (None, None, "user", "no id"), (101, 0, "user", "<|" * 40_000), (102, 0, "user", "same"), (102, 0, "user", "same")]
    return rows


def expected(rows):
    out = {}
    for c, turn, role, text in sorted(((r[0], r[1], r[2] or "", r[3] or "") for r in rows), key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0), r[2].encode(), r[3].encode())):
        out.setdefault(c, []).append((role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digest = {}
    for c, turns in out.items():
        lost = "".join(t for r, t in turns if r == "assistant")
        digest[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(lost), sha(lost))
    return digest


@pytest.mark.parametrize("bits", [10, 4, 2])
def test_chats_read_back(spark, bits):
    rows = [(*r, "own", "own") for r in chats()]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string, formatted string").repartition(5)
    whole, parts = chat_format.format_chats(table, bits)
    assert (parts is None) == (bits == 10)
    found = chat_format.digests(whole, parts).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    assert {r[0]: tuple(r)[1:5] for r in found} == expected([r[:4] for r in rows])
    if parts is not None:
        n = parts.select(F.size(chat_format.read_back(F.col("formatted"))).alias("n")).agg(F.max("n")).first()[0]
        assert n <= 1 << bits


def test_chat_form(spark):
    table = spark.createDataFrame([(1, 2, "user", "b<|"), (1, 1, "user", "a"), (1, 3, "assistant", "x\\"), (1, 4, "assistant", "y")], "conv_id long, turn long, role string, text string")
    (row,) = chat_format.format_chats(table)[0].collect()
    assert row["formatted"] == "<|im_start|>user\na<|im_next|>b<\\p<|im_end|>\n<|im_start|>assistant\nx\\b<|im_next|>y<|im_end|>\n"
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss"]] == ["x\\b", "y"]
    assert chat_format.digests(*chat_format.format_chats(table.limit(0))).count() == 0


def test_parts_of_a_chat_joined_are_the_whole_chat(spark):
    rows = [r for r in chats() if r[0] is not None] + [(103, i, "odd\nrole<|" if 20 < i < 60 else "user", f"t{i}") for i in range(90)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    whole = {r["conv_id"]: r for r in chat_format.format_chats(table)[0].collect()}
    sizes = {r[0]: r[5] for r in chat_format.digests(*chat_format.format_chats(table)).collect()}
    for bits in (5, 3, 0):
        short, parts = chat_format.format_chats(table, bits)
        joined, lost = {}, {}
        for r in sorted(short.select("conv_id", "part", "formatted", "loss").collect() + parts.select("conv_id", "part", "formatted", "loss").collect()):
            before = joined.get(r["conv_id"], "")
            joined[r["conv_id"]] = before + r["formatted"]
            lost.setdefault(r["conv_id"], []).extend((s["start"] + len(before), s["length"]) for s in r["loss"])
        assert joined == {c: r["formatted"] for c, r in whole.items()}
        assert lost == {c: [tuple(s) for s in r["loss"]] for c, r in whole.items()}
        assert {r[0]: r[5] for r in chat_format.digests(short, parts).collect()} == sizes


def test_chat_plan_has_one_shuffle_of_text(spark):
    table = spark.createDataFrame(chats(5)[:20], "conv_id long, turn long, role string, text string")
    plan = chat_format.digests(*chat_format.format_chats(table))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Python" not in plan and "Pandas" not in plan


# Vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    rows = usable(rows)
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    start = [c for _, c in sorted(((i, c) for (i, _, _), c in zip(rows, cut, strict=True) if i is not None), key=lambda r: r[0])][:entries]
    books = [[list(c[p]) for c in start] for p in range(parts)]
    near = lambda part, book: min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for i, members in own.items():
                books[p][i] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    coded = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in c) for c in coded]
    by_label = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    out = [(i, "".join(f"{x:02x}" for _, x in c), e, by_label[label]) for (i, _, label), c, e in zip(rows, coded, errors, strict=True)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest(), books


@pytest.mark.parametrize("most_labels", [1_000_000, 0])
def test_vector_codes(spark, monkeypatch, most_labels):
    monkeypatch.setattr(vector_codes, "MOST_LABELS", most_labels)
    monkeypatch.setattr(vector_codes, "SLICE", 100)
    rows = embeddings(300)
    codes, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(3))
    found = vector_codes.with_label_error(codes).select("vec_id", vector_codes.hex_codes(), "error", "label_error").collect()
    want, digest, _ = brute_codes(rows)
    assert sorted((tuple(r) for r in found), key=str) == want
    assert vector_codes.books_digest(books) == digest


def test_trie_equals_all_distances():
    rng = np.random.default_rng(3)
    for width, spread, block in [(4, 3, 5), (4, 100, 7), (1, 50, 4), (3, 2, 1), (2, 1, 8)]:
        parts = rng.integers(-spread, spread, (400, width))
        parts[:150] = parts[0]
        keys, place, copies = vector_codes.distinct_parts(parts)
        assert (keys[place] == parts).all() and copies.sum() == len(parts)
        assert keys.tolist() == sorted(set(map(tuple, parts.tolist()))) or keys.tolist() == [list(k) for k in sorted(set(map(tuple, parts.tolist())))]
        entries = rng.integers(-spread, spread, (9, width))
        d = ((keys[:, None] - entries[None]) ** 2).sum(2)
        best, least = vector_codes.nearest_entries(keys, entries, block)
        assert (best == d.argmin(1)).all() and (least == d.min(1)).all()
    assert vector_codes.nearest_entries(np.empty((0, 4), np.int64), entries[:, :1].repeat(4, 1))[0].tolist() == []


def test_codes_round_trip_and_odd_tables(spark):
    few = [(i, [float(i), 0.5, -1.0], 0, "", "", "") for i in range(5)] + [(9, [1e30, -1e30, 0.0], None, "", "", "")]
    codes, books = vector_codes.compress(spark.createDataFrame(few, VECTORS), parts=2)
    back = {r["vec_id"]: r["decoded"] for r in vector_codes.decode(codes, books, 3).collect()}
    assert len(back) == 6  # six entries, so every vector is its own entry but for merged means
    assert all(back[i] == [256 * i, 128, -256] for i in range(5))
    empty = spark.createDataFrame(few, VECTORS).where("vec_id < 0")
    codes, books = vector_codes.compress(empty)
    assert vector_codes.with_label_error(codes).count() == 0
    codes, _ = vector_codes.compress(spark.createDataFrame([(None, [1.0] * 16, 3, "", "", "")], VECTORS))
    assert vector_codes.with_label_error(codes).select("error", "label_error").first() == (0, 0)
