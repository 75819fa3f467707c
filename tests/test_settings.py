"""Settings of the scanned tree: leaves, deep merge of layers against plain dictionaries, broken files."""

import json
import random

from pyspark.sql import functions as F

from codesieve.operators import settings as ST


def merge(base, over):
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def flat(value, place=""):
    if isinstance(value, dict) and (value or not place):
        return [x for k, v in value.items() for x in flat(v, f"{place}.{k}" if place else k)]
    return [(place, json.dumps(value, separators=(",", ":")))]


def some(rng, depth=0):
    kinds = [1, "text", True, [1, {"a": 2}], {}] + ([] if depth > 2 else ["object"] * 5)
    pick = lambda: rng.choice(kinds)
    return {k: some(rng, depth + 1) if (v := pick()) == "object" else v for k in "abc" if rng.random() < 0.7}


def test_deep_merge_equals_dictionaries(spark):
    rng = random.Random(5)
    projects = {f"p{i}": [some(rng) for _ in range(3)] for i in range(60)}
    layers = []
    for k in range(3):
        rows = [(p, json.dumps(docs[k])) for p, docs in projects.items()]
        layers.append(ST.leaves(spark.createDataFrame(rows, "project_id string, j string").select("project_id", F.parse_json("j").alias("v"))))
    found = sorted(tuple(r) for r in ST.deep_merge(*layers).collect())
    assert found == sorted((p, *x) for p, (a, b, c) in projects.items() for x in flat(merge(merge(a, b), c)))


def test_broken_settings_fall_back(spark):
    rows = [("a", ST.PATH, b'{"analysis": {"max_depth": 3, "max_workers": "4"}}'), ("b", ST.PATH, b"{broken"), ("c", ST.PATH, b"[1]"), ("d", "other.json", b"{}"), ("e", ST.PATH, None), ("f", ST.PATH, b"{}")]
    files = spark.createDataFrame(rows, "project_id string, path string, content binary")
    own, errors = ST.read_settings(files)
    assert {tuple(r) for r in own.collect()} == {("a", "analysis.max_depth", "3"), ("a", "analysis.max_workers", '"4"')}
    assert {(r.project_id, r.reason) for r in errors.collect()} == {(p, "bad_settings") for p in "bce"}
    base = ST.layer_of(spark, files.where("path = 'config/project.json'"), '{"analysis": {"max_depth": 10, "max_workers": 2}}')
    rows = {r.project_id: (r.max_depth, r.max_workers) for r in ST.project_options(ST.deep_merge(base, own)).collect()}
    assert rows == {"a": (3.0, None), "b": (10.0, 2.0), "c": (10.0, 2.0), "e": (10.0, 2.0), "f": (10.0, 2.0)}
    none, _ = ST.read_settings(files.where("false"))
    assert none.count() == 0
