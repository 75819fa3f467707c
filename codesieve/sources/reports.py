"""Report sinks and the report source."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.operators.scoring import report_summary
from codesieve.schemas import FINDING_JSON, REPORT_JSON
from codesieve.sources.projects import iso_text

_COUNTS = [
    "total_findings", "critical_count", "high_count", "medium_count", "low_count", "info_count",
]
_JSON = {"ignoreNullFields": "false"}


def finding_struct() -> F.Column:
    """A finding in the field order of its JSON form."""
    return F.struct(
        *[
            iso_text(F.col("found_at")).alias("found_at") if n == "found_at" else F.col(n)
            for n in FINDING_JSON.names
        ]
    )


def with_found_at(findings: DataFrame) -> DataFrame:
    if "found_at" in findings.columns:
        return findings
    return findings.withColumn("found_at", F.lit(None).cast("timestamp"))


def finding_json(findings: DataFrame) -> DataFrame:
    """(project_id, json): one JSON object per finding."""
    return with_found_at(findings).select(
        "project_id", F.to_json(finding_struct(), _JSON).alias("json")
    )


def parse_findings(table: DataFrame, column: str = "json") -> DataFrame:
    """Findings back from their JSON form."""
    return table.select(
        "project_id", F.from_json(column, FINDING_JSON).alias("f")
    ).select("project_id", "f.*").withColumn("found_at", F.to_timestamp("found_at"))


def report_json(
    findings: DataFrame, projects: DataFrame, started_at=None, duration: float | None = None
) -> DataFrame:
    """(project_id, json): the whole report of a project as one document.

    A document holds all findings of its project, so this form suits projects whose report
    is meant to be read as one file; `write_finding_rows` has no such limit.
    """
    summary = F.struct(*_COUNTS, "security_score")
    per_project = with_found_at(findings).groupBy("project_id").agg(
        F.array_sort(F.collect_list(finding_struct())).alias("findings")
    )
    none = F.array().cast(REPORT_JSON["findings"].dataType)
    started = F.lit(started_at).cast("timestamp") if started_at else F.current_timestamp()
    return (
        report_summary(findings, projects)
        .join(per_project, "project_id", "left")
        .select(
            "project_id",
            F.to_json(
                F.struct(
                    F.col("project_id").alias("target_path"),
                    iso_text(started).alias("scan_started_at"),
                    F.lit(duration).cast("double").alias("scan_duration"),
                    F.lit(vocab.REPORT_VERSION).alias("analyzer_version"),
                    summary.alias("summary"),
                    F.coalesce("findings", none).alias("findings"),
                ),
                _JSON,
            ).alias("json"),
        )
    )


PART_SIZE = 1000


def report_parts(
    findings: DataFrame,
    projects: DataFrame,
    started_at=None,
    duration: float | None = None,
    part_size: int = PART_SIZE,
    more: DataFrame | None = None,
) -> DataFrame:
    """(project_id, part, n_parts, json): a project's report in documents of about part_size findings.

    Each part has the header and the summary of the whole project. Findings are dealt to parts by a
    hash of their place, so no task gathers a project; a project without findings has one empty part.
    `more` (project_id, n_rows) are rows that the parts are to hold besides.
    """
    header = report_summary(findings, projects)
    held = [F.ceil(F.col("total_findings") / part_size), F.lit(1)]
    if more is not None:
        header = header.join(more, "project_id", "left")
        held.append(F.ceil(F.col("n_rows") / part_size))
    header = header.withColumn("n_parts", F.greatest(*held).cast("int"))
    place = F.concat_ws(":", "file_path", F.col("line_number").cast("string"), "rule_id")
    number = F.conv(F.substring(F.md5(place.cast("binary")), 1, 8), 16, 10).cast("long")
    dealt = with_found_at(findings).join(header.select("project_id", "n_parts"), "project_id")
    order = F.struct("file_path", "line_number", "rule_id", finding_struct().alias("f"))
    gathered = dealt.groupBy("project_id", (number % F.col("n_parts")).cast("int").alias("part")).agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda x: x["f"]).alias("findings")
    )
    started = F.lit(started_at).cast("timestamp") if started_at else F.current_timestamp()
    document = F.struct(
        F.col("project_id").alias("target_path"),
        iso_text(started).alias("scan_started_at"),
        F.lit(duration).cast("double").alias("scan_duration"),
        F.lit(vocab.REPORT_VERSION).alias("analyzer_version"),
        F.struct(*_COUNTS, "security_score").alias("summary"),
        F.coalesce("findings", F.array().cast(REPORT_JSON["findings"].dataType)).alias("findings"),
    )
    numbered = header.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
    return numbered.join(gathered, ["project_id", "part"], "left").select(
        "project_id", "part", "n_parts", F.to_json(document, _JSON).alias("json")
    )


def write_reports(findings: DataFrame, projects: DataFrame, path: str, **header) -> None:
    report_json(findings, projects, **header).select("json").write.mode("overwrite").text(path)


def write_finding_rows(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines, a directory per project; no project is gathered in one place."""
    rows = with_found_at(findings).select("project_id", finding_struct().alias("f"))
    rows.select("project_id", "f.*").write.mode("overwrite").partitionBy("project_id").option(
        "ignoreNullFields", False
    ).json(path)


def csv_rows(findings: DataFrame) -> DataFrame:
    fields = ["file_path", "line_number", "severity", "rule_id", "message"]
    return findings.select(*[F.col(f).alias(h) for f, h in zip(fields, vocab.CSV_HEADER)])


def write_csv(findings: DataFrame, path: str) -> None:
    csv_rows(findings).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return parse_reports(spark.read.text(path), "value")


def parse_reports(table: DataFrame, column: str = "json") -> DataFrame:
    """One row per report: header fields and its findings array."""
    return table.select(F.from_json(column, REPORT_JSON).alias("r")).select(
        F.col("r.target_path").alias("project_id"),
        F.to_timestamp_ntz("r.scan_started_at").alias("scan_started_at"),
        "r.scan_duration",
        F.coalesce("r.analyzer_version", F.lit(vocab.REPORT_VERSION)).alias("analyzer_version"),
        "r.findings",
    )


def report_findings(reports: DataFrame) -> DataFrame:
    return reports.select("project_id", F.explode("findings").alias("f")).select(
        "project_id", "f.*"
    )


def recompute_summary(reports: DataFrame) -> DataFrame:
    """The summary of a loaded report is computed from the findings of all its parts, not trusted."""
    return report_summary(report_findings(reports), reports.select("project_id").distinct())


def write_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("append").parquet(path)
