"""Findings: union, keep-first de-duplication, filters, enrichment, display forms, top lists."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions import paths as P
from codesieve.functions import scoring as S
from codesieve.schemas import FINDING, FINDING_ORDER

KEY = ["project_id", "file_path", "line_number", "rule_id"]


def finding(**values: Column | str | int | float | None) -> list[Column]:
    """Columns of one finding; the severity is put in upper case, missing fields are null."""
    columns = []
    for field in FINDING.fields:
        value = values.get(field.name)
        column = value if isinstance(value, Column) else F.lit(value)
        if field.name == "severity":
            column = F.upper(column)
        columns.append(column.cast(field.dataType).alias(field.name))
    return columns


def union_findings(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dedup(findings: DataFrame, keep: str = "first") -> DataFrame:
    """One row per (file, line, rule): the first detected, or the most severe.

    A minimum over a struct, not a window: equal keys meet in map-side partial
    aggregates, so a line with very many hits never lands in one task as rows.
    """
    payload = [c for c in findings.columns if c not in KEY + FINDING_ORDER]
    order = [F.col(c) for c in FINDING_ORDER]
    if keep == "max_severity":
        order = [S.severity_rank(F.col("severity")), *order]
    elif keep != "first":
        raise ValueError(f"keep must be 'first' or 'max_severity', not {keep!r}")
    ranked = F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(order)], F.struct(*payload).alias("row")
    )
    return (
        findings.groupBy(*KEY)
        .agg(F.min(ranked).alias("m"))
        .select(*KEY, "m.row.*")
        .select(*[c for c in findings.columns if c not in FINDING_ORDER])
    )


# --- filters ------------------------------------------------------------------------


def of_severity(findings: DataFrame, severity: str) -> DataFrame:
    return findings.where(F.col("severity") == severity.upper())


def high_priority(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("severity").isin("CRITICAL", "HIGH"))


def min_severity(findings: DataFrame, lowest: str) -> DataFrame:
    """Severity names at or above the threshold, as a pushable membership test."""
    bound = vocab.SEVERITIES[lowest.upper()][1]
    names = [s for s, (_, order, _) in vocab.SEVERITIES.items() if order >= bound]
    return findings.where(F.col("severity").isin(*names))


def apply_policy(
    findings: DataFrame,
    enabled_severities: list[str] | None = None,
    disabled_rules: list[str] | None = None,
    min_confidence: float | None = None,
) -> DataFrame:
    """Configured rule policy; a finding without confidence counts as certain."""
    out = findings
    if enabled_severities is not None:
        out = out.where(F.col("severity").isin(*enabled_severities))
    if disabled_rules:
        out = out.where(~F.col("rule_id").isin(*disabled_rules))
    if min_confidence is not None:
        out = out.where(F.coalesce("confidence", F.lit(1.0)) >= min_confidence)
    return out


# --- enrichment and display -----------------------------------------------------------


def enrich(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Add cwe_id and owasp_category of the rule. Spark broadcasts the rules if they are small."""
    meta = rules.select(
        F.col("id").alias("rule_id"),
        F.col("metadata.cwe_id").alias("rule_cwe"),
        F.col("metadata.owasp_category").alias("owasp_category"),
    )
    return (
        findings.join(meta, "rule_id", "left")
        .withColumn("cwe_id", F.coalesce("cwe_id", "rule_cwe"))
        .drop("rule_cwe")
    )


def location(file_path: Column, line_number: Column, column: Column) -> Column:
    """file:line, and :column where there is one."""
    shown = F.when(column != 0, column.cast("string"))
    return F.concat_ws(":", file_path, F.coalesce(line_number.cast("string"), F.lit("None")), shown)


def with_display(findings: DataFrame) -> DataFrame:
    """Location text, one-line text, short path and shortened message."""
    place = location(F.col("file_path"), F.col("line_number"), F.col("column"))
    message = F.col("message")
    return (
        findings.withColumn("location", place)
        .withColumn(
            "display",
            F.concat(F.lit("["), "severity", F.lit("] "), message, F.lit(" ("), place, F.lit(")")),
        )
        .withColumn("short_path", P.short_path(F.col("file_path")))
        .withColumn(
            "short_message",
            F.when(F.char_length(message) > 45, F.concat(F.left(message, F.lit(45)), F.lit("...")))
            .otherwise(message),
        )
    )


# --- top lists ------------------------------------------------------------------------

_PLACE = ["file_path", "line_number", "rule_id"]


def top_findings(findings: DataFrame, limit: int = 10) -> DataFrame:
    """Most severe findings over everything; ties in path and line order."""
    return findings.orderBy(S.severity_rank(F.col("severity")), "project_id", *_PLACE).limit(limit)


# Up to this limit Spark ranks inside the map tasks too; beyond, a key is ranked in salted parts first.
EARLY_LIMIT, SALTS = 1000, 64


def _first_of(findings: DataFrame, key: str, order: list, limit: int) -> DataFrame:
    """The first `limit` rows of each key with their rank. No task holds more of a key than SALTS * limit rows of its
    parts, or `limit` rows of each map task."""
    if limit > EARLY_LIMIT:
        part = Window.partitionBy(key, "_salt").orderBy(*order)
        salted = findings.withColumn("_salt", F.pmod(F.xxhash64("project_id", *_PLACE), F.lit(SALTS)))
        findings = salted.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= limit).drop("_salt", "_rank")
    return findings.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= limit)


def top_per_project(findings: DataFrame, limit: int = 10) -> DataFrame:
    """Most severe findings of each project."""
    return _first_of(findings, "project_id", [S.severity_rank(F.col("severity")), *_PLACE], limit)


def top_per_severity(findings: DataFrame, limit: int = 5) -> DataFrame:
    return _first_of(findings, "severity", ["project_id", *_PLACE], limit)


def first_errors(errors: DataFrame, limit: int = 5) -> DataFrame:
    return errors.orderBy("project_id", "path", "reason").limit(limit)


def family_coverage(findings: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Which expected rule families fired, with the number of findings of each."""
    families = families or vocab.EXPECTED_FAMILIES
    counts = findings.agg(
        *[F.count_if(F.contains("rule_id", F.lit(f))).alias(f) for f in families]
    )
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.col(f).alias("n")) for f in families])
    return counts.select(F.explode(rows).alias("r")).select(
        "r.family", "r.n", (F.col("r.n") > 0).alias("detected")
    )
