import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_files(spark):
    def make(sources: dict, project: str = "p"):
        rows = [
            (project, path, len(data), None, data)
            for path, text in sources.items()
            for data in [text if isinstance(text, bytes) else text.encode()]
        ]
        return spark.createDataFrame(
            rows,
            "project_id string, path string, size_bytes bigint, last_modified timestamp, content binary",
        )

    return make


@pytest.fixture(scope="session")
def scan_source(spark, make_files):
    """Findings of one Python source, as sorted tuples."""
    from codesieve.operators.findings import dedup
    from codesieve.operators.inventory import with_language
    from codesieve.operators.patterns import builtin_patterns
    from codesieve.plans.scan import compile_rules, detect

    def scan(text, pack=False, columns=("line_number", "rule_id", "severity", "column"), keep="first"):
        files = with_language(make_files({"app.py": text}))
        found = dedup(detect(files, compile_rules() if pack else builtin_patterns()), keep)
        rows = [tuple(r) for r in found.select(*columns).collect()]
        return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))

    return scan
