"""Files that appear, change and go: totals equal a fresh scan."""

import datetime
import tempfile

import pytest
from pyspark.sql import functions as F

from codesieve.streaming import tracked as TK

EVENT = "project_id string, path string, size_bytes bigint, last_modified timestamp, content binary, version bigint, deleted boolean"


def event(path, text, version, deleted=False, project="p"):
    data = None if text is None else text.encode()
    return (project, path, None if data is None else len(data), datetime.datetime(2024, 1, 1 + (version or 0)), data, version, deleted)


@pytest.fixture
def follow(spark):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    profiles = spark.createDataFrame([("p", "python", ["python"]), ("q", "python", ["python"])], "project_id string, primary_language string, target_languages array<string>")

    def run(*events):
        from codesieve.plans.scan import compile_rules

        spark.createDataFrame(list(events), EVENT).coalesce(1).write.mode("append").parquet(f"{out}/arrived")
        TK.track(spark.readStream.schema(EVENT).parquet(f"{out}/arrived"), compile_rules(), f"{out}/scan", profiles)
        return {r.project_id: r.total_findings for r in TK.tracked_summary(spark, f"{out}/scan", profiles.select("project_id")).collect()}

    run.out = f"{out}/scan"
    return run


def test_edits_deletions_repeats_and_late_events(spark, follow):
    one, two, clean = "eval(x)\n", "eval(x)\nexec(y)\n", "x = 1\n"
    assert follow(event("a.py", one, 1), event("b.py", two, 1), event("c.py", clean, 1, project="q"), event("x.css", one, 1), event("n.py", one, None))["q"] == 0
    single = follow(event("b.py", two, 2, True))["p"]
    assert single > 0
    both = follow(event("a.py", two, 3), event("a.py", two, 3), event("a.py", clean, 2))["p"]
    assert both > single
    # Late, repeated and equal versions change nothing, also of a deleted file.
    assert follow(event("a.py", clean, 1), event("a.py", clean, 3), event("b.py", two, 1))["p"] == both
    assert follow(event("b.py", one, 4))["p"] == both + single
    # Content that is lost, or over the limit (10 MB), counts nothing until it is back.
    assert follow(event("b.py", None, 5), event("a.py", two + "#" * 10_500_000, 4))["p"] == 0
    assert follow(event("a.py", one, 6))["p"] == single
    assert follow(event("a.py", None, 7, True), event("new.py", None, 1, True))["p"] == 0
    kinds = [r.change for r in TK.changes(spark, follow.out).where("path = 'a.py'").orderBy("version").collect()]
    assert kinds[0] == "added" and kinds[-1] == "deleted" and set(kinds[1:-1]) <= {"changed", "added"}
    # Retraction ends at nothing, never below.
    left = TK.changes(spark, follow.out).groupBy("path").agg(*[F.sum(c).alias(c) for c in ["n_files", *TK.COUNTS]])
    assert all(v >= 0 for r in left.collect() for v in r[1:])
    assert {r.path: r.n_files for r in left.collect()}["a.py"] == 0


def test_only_what_differs_from_the_listing_is_pending(spark, follow):
    follow(event("same.py", "x = 1\n", 1), event("edited.py", "x = 1\n", 1), event("gone.py", "x = 1\n", 1), event("before.py", "x", 1))
    follow(event("before.py", None, 2, True))
    listing = spark.createDataFrame([event("same.py", "x = 1\n", 1)[:4], event("edited.py", "x = 23\n", 3)[:4], event("new.py", "y", 3)[:4]], "project_id string, path string, size_bytes bigint, last_modified timestamp")
    rows = TK.pending(listing, spark, follow.out, 3).collect()
    assert {(r.path, r.deleted) for r in rows} == {("edited.py", False), ("gone.py", True), ("new.py", False)}
    assert {r.version for r in rows} == {3}


def test_a_difference_sorts_and_casts_no_frames(monkeypatch):
    """It runs once a file, where sorting, joining or casting frames of a row or two costs far more than the comparison."""
    import pandas as pd

    class State:
        exists = False

        def update(self, value):
            self.value = value

    def rows(n):
        return pd.DataFrame(
            {"project_id": "p", "path": "a.py", "version": range(n), "size_bytes": [None] * n, "last_modified": pd.NaT, "deleted": [i % 2 == 0 for i in range(n)], "n_files": [i % 2 for i in range(n)], **{c: [2 + i for i in range(n)] for c in TK.COUNTS}}
        )

    def run(frames):
        state = State()
        (out,) = TK._difference(("p", "a.py"), iter(frames), state)
        return state.value, out

    frames, tie = [rows(4), rows(2)], rows(2).assign(version=7)
    for place, name in ((pd, "concat"), (pd.DataFrame, "sort_values"), (pd.DataFrame, "astype")):
        monkeypatch.setattr(place, name, None)
    value, out = run(frames)
    assert value == (3, 1, *[5] * len(TK.COUNTS)) and out["change"].tolist() == ["added"] and out["size_bytes"].isna().all() and out["last_modified"].isna().all()
    assert run([tie])[0] == (7, 1, *[3] * len(TK.COUNTS))  # of equal versions one that is not deleted
