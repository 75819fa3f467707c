"""Headline timings: one JSON line on standard output.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query is run once to warm up and then BENCH_RUNS times; the median is reported.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codesieve.operators import inventory as I  # noqa: E402
from codesieve.operators import lines as L  # noqa: E402
from codesieve.operators import syntax as SY  # noqa: E402
from codesieve.plans import corpus as C  # noqa: E402
from codesieve.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "document_line_counts",
    "secret_hits_documents",
    "builtin_regex_hits",
    "rule_regex_hits",
    "python_syntax_findings",
    "taint_vars",
    "project_info",
    "findings_dedup",
    "security_score",
    "scan_summary",
]


def noop(df) -> None:
    """Run the whole plan and drop its rows."""
    df.write.format("noop").mode("overwrite").save()


def measure(build, runs: int) -> tuple[float, float]:
    """Median seconds of a whole query, and of the part that builds and plans it."""
    noop(build())
    times, plans = [], []
    for _ in range(runs):
        start = time.perf_counter()
        df = build()
        df._jdf.queryExecution().executedPlan()
        plans.append(time.perf_counter() - start)
        noop(df)
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3), round(statistics.median(plans), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    both = {name: measure(lambda q=QUERIES[name]: q(spark, sf_dir), runs) for name in HEADLINE}
    documents = C.document_files(spark, sf_dir)
    n_lines = L.line_counts(documents, "path").agg(F.sum("n_split_lines")).first()[0]
    python = I.files_of_language(C.corpus_files(spark, sf_dir), "python")
    facts = SY.extract_facts(python).select(F.size("facts"))
    both["syntax_facts"] = measure(lambda: facts, runs)
    times = {name: whole for name, (whole, _) in both.items()}
    rates = {
        "pattern_lines_per_sec": round(n_lines / times["secret_hits_documents"]),
        "syntax_files_per_sec": round(python.count() / times["syntax_facts"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "planning": {name: plan for name, (_, plan) in both.items()},
                "rates": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
