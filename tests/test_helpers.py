"""Small public helpers that no query calls."""

from pyspark.sql import functions as F

from codesieve.functions.scoring import severity_order
from codesieve.operators.inventory import project_sizes
from codesieve.plans.scan import scan
from codesieve.sources import reports
from codesieve.sources.files import empty_files, from_table


def test_any_table_as_files(spark, tmp_path):
    rows = [("p", "a.py", "eval(x)\n", 1), ("p", "b.py", None, 2), (None, "c.py", "é", 3)]
    files = from_table(spark.createDataFrame(rows, "repo string, name string, body string, content int"), "repo", "name", "body")
    assert files.columns == empty_files(spark).columns
    sizes = {r["path"]: r["size_bytes"] for r in files.collect()}
    assert sizes == {"a.py": 8, "b.py": None, "c.py": 2}
    assert {r["project_id"]: r["size_mb"] for r in project_sizes(files).collect()} == {"p": 8 / 2**20, None: 2 / 2**20}
    assert project_sizes(empty_files(spark)).count() == 0

    stats = scan(files.where("path = 'a.py'")).stats
    for _ in range(2):
        reports.write_stats(stats, str(tmp_path / "stats"))
    kept = spark.read.parquet(str(tmp_path / "stats"))
    assert [(r["project_id"], r["files_analyzed"], r["total_lines_scanned"]) for r in kept.collect()] == [("p", 1, 1)] * 2


def test_severity_order(spark):
    names = ["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL", "other", None]
    table = spark.createDataFrame([(s,) for s in names], "s string")
    found = {r["s"]: r["n"] for r in table.select("s", severity_order(F.col("s")).alias("n")).collect()}
    assert [found[s] for s in names] == [0, 1, 2, 3, 4, None, None]
