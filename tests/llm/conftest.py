import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=120, seed=3):
    """Small documents with exact and near copies, shared lines and passages, nulls, empty and long texts, ties."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    line = "A very common line that many documents share."
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) + "." for _ in range(rng.randint(1, 5)))
        if i % 3 == 0:
            text += f"\n  {line.upper() if i % 2 else line} \t"
        if i % 4 == 0:
            text += f"\n{passage}"
        if i % 5 == 4 and rows:
            old = rows[rng.randrange(len(rows))][1] or ""
            parts = old.split(" ")
            if i % 10 == 4 and parts:
                parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "a", "b", None]), len(text)))
    rows.append((n, None, None, None, None))
    rows.append((n + 1, "", "en", "a", 0))
    rows.append((n + 2, "   \n\t\n", "en", "a", 6))
    rows.append((n + 3, "abc " * 6000 + "x" * 5000, "en", "a", 29000))
    rows.append((n + 4, "one two three", "de", "b", 13))
    rows.append((n + 5, "One two THREE", "de", "b", 13))
    rows.append((None, f"{line}\nwithout an id", "en", "a", 10))
    rows.append(rows[7])
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    """Documents with columns that operators also make."""
    names = "keys kept n_lines n_dropped quality base_failed in_band band_lang ids decoded n_tokens epoch _row _key _id rid p h"
    return spark.createDataFrame([(*r, *(["own"] * len(names.split()))) for r in rows[:40]], SCHEMA + "".join(f", {c} string" for c in names.split()))
