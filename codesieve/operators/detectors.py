"""Detectors: functions from files to findings, and the table that routes files to them.

A detector takes (files, patterns) and returns findings with their detection order. To add
one, write such a function and pass it to `scan` with a row of the detector table.
"""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions import paths as P
from codesieve.functions.literals import literal_map
from codesieve.operators.lines import explode_lines
from codesieve.operators.patterns import Pattern, first_matches, to_findings
from codesieve.operators.syntax import extract_facts, syntax_findings

Detect = Callable[[DataFrame, list[Pattern]], DataFrame]


@dataclass(frozen=True)
class Detector:
    """`languages` empty: every file that reaches the scan."""

    name: str
    detect: Detect
    languages: tuple = ()
    extensions: tuple = ()
    version: str = "1.0.0"


def line_pattern_findings(files: DataFrame, patterns: list[Pattern]) -> DataFrame:
    lines = explode_lines(files, "project_id", "path", "language")
    return to_findings(first_matches(lines, patterns))


def python_syntax_findings(files: DataFrame, patterns: list[Pattern]) -> DataFrame:
    return syntax_findings(extract_facts(files))


LINE_PATTERNS = Detector("line_patterns", line_pattern_findings)
PYTHON_SYNTAX = Detector("python_syntax", python_syntax_findings, ("python",), (".py", ".pyw"))
DEFAULT = (LINE_PATTERNS, PYTHON_SYNTAX)


def detector_table(spark: SparkSession, detectors: tuple = DEFAULT) -> DataFrame:
    """Catalogue: a row per detector with its languages and extensions."""
    return spark.createDataFrame(
        [(d.name, list(d.languages), list(d.extensions), d.version) for d in detectors],
        "name string, languages array<string>, extensions array<string>, version string",
    )


def route_files(files: DataFrame, detectors: tuple = DEFAULT) -> DataFrame:
    """Detector chosen by extension and by language for every file; null where there is none."""
    by_extension = {e: d.name for d in detectors for e in d.extensions}
    by_language = {lang: d.name for d in detectors for lang in d.languages}
    return (
        files.withColumn(
            "by_extension",
            F.try_element_at(literal_map(by_extension), P.extension(F.col("path"))),
        )
        .withColumn(
            "by_language",
            F.try_element_at(literal_map(by_language), P.language(F.col("path"))),
        )
    )


def analyzable(detector: Detector) -> F.Column:
    """Whether the detector knows the extension of a file."""
    return P.extension(F.col("path")).isin(*detector.extensions)


def can_analyze(files: DataFrame, detector: Detector) -> DataFrame:
    return files.where(analyzable(detector))


def unroutable(files: DataFrame, detectors: tuple = DEFAULT) -> DataFrame:
    return route_files(files, detectors).where("by_extension is null and by_language is null")
