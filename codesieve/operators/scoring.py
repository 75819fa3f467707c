"""Findings to counts, scores and gates. All group sums are additive, so they combine on the
map side and a project with a third of all findings still arrives as a few partial rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions import scoring as S

COUNTS = {s: f"{s.lower()}_count" for s in vocab.SEVERITIES}


def severity_totals(findings: DataFrame) -> DataFrame:
    """Additive totals per project: a count per severity and the penalty sum."""
    counts = [
        F.count_if(F.col("severity") == s).alias(name) for s, name in COUNTS.items()
    ]
    return findings.groupBy("project_id").agg(
        *counts,
        F.coalesce(F.sum(S.penalty(F.col("severity"))), F.lit(0)).alias("penalty"),
    )


def merge_totals(*totals: DataFrame) -> DataFrame:
    """Totals of a union of findings from the totals of its parts."""
    both = totals[0]
    for more in totals[1:]:
        both = both.unionByName(more)
    return both.groupBy("project_id").agg(
        *[F.sum(c).alias(c) for c in [*COUNTS.values(), "penalty"]]
    )


def summarize(totals: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """Report summary per project. Projects without findings score 100."""
    if projects is not None:
        totals = projects.select("project_id").join(totals, "project_id", "left").fillna(0)
    total = sum((F.col(c) for c in COUNTS.values()), F.lit(0))
    score = F.greatest(F.lit(0.0), 100.0 - F.col("penalty"))
    return (
        totals.withColumn("total_findings", total.cast("bigint"))
        .withColumn("security_score", score)
        .drop("penalty")
    )


def report_summary(findings: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    return summarize(severity_totals(findings), projects)


def classify(summary: DataFrame) -> DataFrame:
    """Class, label, band, gate code and the clean and critical flags of a summary."""
    score = F.col("security_score")
    return (
        summary.withColumn("score_class", S.score_class(score))
        .withColumn("score_label", S.score_label(score))
        .withColumn("score_band", S.score_band(score))
        .withColumn("gate_code", S.gate_code(F.col("critical_count"), F.col("high_count")))
        .withColumn("is_clean", F.col("total_findings") == 0)
        .withColumn("has_critical_issues", F.col("critical_count") > 0)
    )


def rules_triggered(findings: DataFrame) -> DataFrame:
    """Distinct rule ids per project; ids are first reduced to one row each."""
    return (
        findings.select("project_id", "rule_id")
        .distinct()
        .groupBy("project_id")
        .agg(F.count("*").alias("rules_triggered"))
    )


def add_findings(summary_totals: DataFrame, more: DataFrame) -> DataFrame:
    """Totals after appending findings, without touching the earlier ones."""
    return merge_totals(summary_totals, severity_totals(more))
