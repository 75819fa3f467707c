"""Severity and score columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions.literals import literal_map


def severity_rank(severity: Column) -> Column:
    """0 for CRITICAL up to 4 for INFO: the display order."""
    return F.try_element_at(literal_map({k: v[0] for k, v in vocab.SEVERITIES.items()}), severity)


def severity_order(severity: Column) -> Column:
    """0 for INFO up to 4 for CRITICAL: the threshold order."""
    return F.try_element_at(literal_map({k: v[1] for k, v in vocab.SEVERITIES.items()}), severity)


def penalty(severity: Column) -> Column:
    return F.try_element_at(literal_map({k: v[2] for k, v in vocab.SEVERITIES.items()}), severity)


def score_class(score: Column) -> Column:
    """Scores from 50 up to 75 have no class of their own and fall into the last one."""
    return (
        F.when(score.isNull(), None)
        .when(score == 100, "clean")
        .when(score >= 90, "excellent")
        .when(score >= 75, "good")
        .when((score < 50) & (score >= 25), "poor")
        .otherwise("critical")
    )


def score_label(score: Column) -> Column:
    return F.try_element_at(literal_map(vocab.SCORE_LABELS), score_class(score))


def score_band(score: Column) -> Column:
    """Five display bands; unlike the class, the 50 band exists."""
    return (
        F.when(score >= 90, 90).when(score >= 75, 75).when(score >= 50, 50).when(score >= 25, 25)
    ).otherwise(0)


def gate_code(critical: Column, high: Column) -> Column:
    """2 if anything is critical, 1 if too much is high, else 0."""
    return F.when(critical > 0, 2).when(high > vocab.GATE_HIGH_LIMIT, 1).otherwise(0)
