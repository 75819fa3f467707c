"""Streams of tables and of files."""

import tempfile

import pytest

from codesieve.operators.inventory import detect_languages
from codesieve.plans import scan as SCAN
from codesieve.plans.queries import QUERIES
from codesieve.streaming import incremental as INC

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("n_files", [0, 1, 3])
def test_a_table_is_a_file_or_a_folder_of_files(spark, n_files):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = spark.createDataFrame([(i, f"x = {i}\npassword = 'abcdef{i}99'\n", "en", "web", 30) for i in range(30)], DOCUMENTS)
    if n_files:
        rows.repartition(n_files).write.parquet(f"{base}/documents.parquet")
    else:
        rows.toPandas().to_parquet(f"{base}/documents.parquet")
    found = QUERIES["incremental_scan"](spark, base)
    assert {r.file_path for r in found.collect()} == {f"docs/d{i}.py" for i in range(30)}


def test_batches_are_analyzed_once_and_profiles_measured_once(spark, make_files, monkeypatch):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    files = make_files({f"f{i}.py": "eval(x)\n" if i % 3 else "def broken(\n" for i in range(9)})
    files.repartition(3, "path").write.parquet(f"{base}/arrived")
    n_files = len(spark.read.parquet(f"{base}/arrived").inputFiles())
    assert n_files > 1
    calls = {"measured": 0, "analyze": 0}

    def counted(place, name):
        real = getattr(place, name)

        def call(*args, **how):
            calls[name] += 1
            return real(*args, **how)

        monkeypatch.setattr(place, name, call)

    counted(SCAN, "measured")
    if hasattr(INC, "measured"):
        counted(INC, "measured")
    from codesieve.operators import file_pass as FP

    counted(FP, "analyze")
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/arrived")
    INC.scan_increment(stream, SCAN.compile_rules(), f"{base}/scan", profiles=detect_languages(files))
    assert calls == {"measured": 1, "analyze": n_files}
    monkeypatch.undo()
    whole = SCAN.scan(files)
    found = INC.increment_findings(spark, f"{base}/scan")
    assert sorted(map(str, found.select(*whole.findings.columns).collect())) == sorted(map(str, whole.findings.collect()))
    errors = spark.read.parquet(f"{base}/scan/errors").drop("batch")
    assert sorted(map(str, errors.collect())) == sorted(map(str, whole.errors.select(*errors.columns).collect()))
