"""The sink of result records and its commit."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from codesieve.sources import records as RC


def new_dir() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(spark, *projects):
    report = {"target_path": "p", "summary": {"total_findings": 0}, "findings": []}
    document = json.dumps({"report": report, "stats": {"files_analyzed": 3}, "errors": ["é \n\""]}, ensure_ascii=False)
    return spark.createDataFrame([(p, 0, 1, document) for p in projects], RC.RECORD).repartition(3)


def projects(spark, root):
    return sorted(r.project_id for r in RC.read_records(spark, root).collect())


def test_commits_replace_or_append_and_failures_leave_nothing(spark):
    root = f"{new_dir()}/records"
    assert projects(spark, root) == []
    RC.write_records(rows(spark, "a", "b", "ü\n"), root)
    assert projects(spark, root) == ["a", "b", "ü\n"]
    one = RC.read_records(spark, root).first()
    assert one.errors == ['é \n"'] and one.stats.files_analyzed == 3 and one.execution_time >= 0

    def fails(p):
        if p == "d":
            raise ValueError("planted")
        return p

    broken = rows(spark, "c", "d").withColumn("project_id", F.udf(fails)("project_id"))
    with pytest.raises(Exception, match="planted"):
        RC.write_records(broken, root)
    assert projects(spark, root) == ["a", "b", "ü\n"]

    RC.write_records(rows(spark, "e"), root, "append")
    assert projects(spark, root) == ["a", "b", "e", "ü\n"]
    assert {n for n in os.listdir(root) if n.startswith("job-")} == {j["job"] for j in RC.committed(root)}
    RC.write_records(rows(spark, "f"), root)
    assert projects(spark, root) == ["f"]
    assert len([n for n in os.listdir(root) if n.startswith("job-")]) == 1
    RC.write_records(rows(spark, "f").where("false"), root)
    assert projects(spark, root) == []


def test_pieces_of_lost_attempts_do_not_count(spark):
    import pyarrow as pa

    root = new_dir()
    writer = RC.RecordWriter(root, True)
    document = '{"report":{"target_path":"p"},"stats":{},"errors":[]}'
    batch = pa.RecordBatch.from_pylist([{"project_id": "p", "part": 0, "n_parts": 1, "json": document}])
    writer.write(iter([batch]))  # an attempt whose executor is lost before its message arrives
    second = writer.write(iter([batch]))
    assert projects(spark, root) == []
    writer.commit([second, writer.write(iter([])), None])
    assert projects(spark, root) == ["p"]
    assert os.listdir(f"{root}/{writer.job}") == [second.place.split("/")[1]]


def test_records_of_a_scan(spark, make_files):
    from codesieve.plans.scan import scan

    sources = {f"m{i}.py": "eval(x)\nexec(y)\n" for i in range(30)} | {"deep.py": "x = " + "(" * 500 + ")" * 500}
    files = make_files(sources).unionByName(make_files({"clean.py": "x = 1\n"}, "clean")).unionByName(make_files({"a.css": "x"}, "none"))
    out = new_dir()
    result = scan(files).export(out, "2024-01-01 00:00:00", part_size=7)
    back = RC.read_records(spark, f"{out}/records").collect()
    n = result.findings.count()
    mine = [r for r in back if r.project_id == "p"]
    assert {r.part for r in mine} == set(range(-(-n // 7))) and sum(len(r.report.findings) for r in mine) == n
    assert all(f.found_at == "2024-01-01T00:00:00" for r in mine for f in r.report.findings)
    assert {r.report.summary.total_findings for r in mine} == {n}
    stats = {r.project_id: r.asDict() for r in result.stats.collect()}
    for r in back:
        assert r.stats.asDict() == {k: stats[r.project_id][k] for k in RC.STATS}
    errors = {r.project_id: [e for x in back if x.project_id == r.project_id for e in x.errors] for r in back}
    assert errors["clean"] == [] and errors["none"] == ["unsupported_language"]
    assert len(errors["p"]) == result.errors.where("project_id = 'p'").count()


def test_a_task_holds_few_documents_at_once(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    document = '{"report":{"target_path":"p"},"stats":{},"errors":["' + "é" * 50_000 + '"]}'
    writer, root = None, new_dir()
    batch = pa.RecordBatch.from_pylist([{"project_id": "p", "part": i, "n_parts": 300, "json": document} for i in range(300)])
    writer = RC.RecordWriter(root, True)
    tracemalloc.start()
    piece = writer.write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert piece.n_records == 300 and peak < 20 * len(document.encode())
    writer.commit([piece])
    assert {len(r.errors[0]) for r in RC.read_records(spark, root).collect()} == {50_000}
    # Batches that reach a task are small too, and the session's own size is back afterwards.
    sizes, plain = [], type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, key, value: (sizes.append((key, value)), plain(self, key, value))[1])
    before = spark.conf.get(RC.BATCH_ROWS)
    RC.write_records(rows(spark, "a"), new_dir())
    assert sizes == [(RC.BATCH_ROWS, RC.BATCH_RECORDS), (RC.BATCH_ROWS, before)] and spark.conf.get(RC.BATCH_ROWS) == before


def test_reports_are_made_from_findings_that_are_stored(spark):
    from codesieve.plans.queries import QUERIES

    found = QUERIES["report_roundtrip"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "events.parquet" not in plan  # no source is scanned again
    assert found.count() == 9
