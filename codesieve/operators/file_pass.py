"""One pass per file: lines, pattern hits, syntax facts and taint meet in the row of their file.

A file's findings are one array, in which the first (or most severe) of a line and rule is kept by comparing neighbours.
So nothing is shuffled before the roll-up, and the text is read once for findings, line counts and
problems together; what nobody asks for is pruned.
"""

from dataclasses import fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions import regex as R
from codesieve.functions import text as X
from codesieve.functions.arrays import computed
from codesieve.functions.literals import quote
from codesieve.functions.pyfacts import py_facts
from codesieve.operators import patterns as PT
from codesieve.operators import syntax as SY
from codesieve.operators.lines import with_text
from codesieve.operators.patterns import Pattern
from codesieve.operators.rule_tables import Matcher, TablePart, TablePattern, severity_ranked
from codesieve.operators.taint import with_taint
from codesieve.schemas import CANDIDATE, CANDIDATES, FINDING_ORDER

LINE, PYTHON = "line_patterns", "python_syntax"
PROBLEMS = "array<struct<reason: string, message: string>>"
# The folded line as SQL, for the name `line` of a lambda.
FOLDED = "CASE WHEN octet_length(line) = char_length(line) THEN lower(line) ELSE lower(translate(line, 'ſKİı', 'skii')) END"


def _text(value) -> str:
    return f"CAST({quote(value)} AS STRING)"


def _hit(p: Pattern) -> str:
    """The candidate of a pattern on `line`, the i-th of its file."""
    column = f"char_length(split(line, {quote(p.java)}, 2)[0]) + 1"
    values = {
        "line_number": "i + 1", "rule_id": _text(p.rule_id), "phase": str(p.phase), "rule_ord": str(p.rule_ord), "pattern_ord": str(p.pattern_ord),
        "match_ord": "0", "column": column, "severity": _text(p.severity), "message": _text(p.message), "category": _text(p.category),
        "confidence": f"CAST({quote(p.confidence)} AS DOUBLE)", "has_line": "true",
    }
    return "named_struct(" + ", ".join(f"'{f.name}', {values[f.name]}" for f in CANDIDATE.fields) + ")"


def literal_hits(patterns: list[Pattern]) -> Column:
    """array<CANDIDATE>: the first pattern of every rule that hits, on every line of the column `lines`."""
    rules = ["CASE " + " ".join(f"WHEN {PT._test(p)} THEN {_hit(p)}" for p in rule) + " END" for rule in PT._rules_of(patterns)]
    blocks = [f"array({', '.join(rules[i : i + PT.BLOCK])})" for i in range(0, len(rules), PT.BLOCK)]
    found = f"CASE WHEN {PT._has_anchor(patterns)} THEN array_compact(concat({', '.join(blocks)})) END"
    # The folded line is computed once per line: as the only element of an array that a second lambda takes.
    return F.expr(f"flatten(array_compact(transform(lines, (line, i) -> get(transform(array({FOLDED}), folded -> {found}), 0))))")


def _python_part(files: DataFrame, patterns: list[Pattern]) -> TablePart:
    """Patterns that the JVM cannot run, as a matcher."""
    own = {f.name for f in fields(TablePattern)} & {f.name for f in fields(Pattern)}
    rows = [TablePattern(**{n: getattr(p, n) for n in own}, flags=p.flags, words=R.anchors(p.text)) for p in patterns]
    return TablePart(files.sparkSession.sparkContext.broadcast(Matcher(rows)))


def _syntax_candidates() -> Column:
    """Syntax findings of the columns `facts` and `flags` as candidates."""

    def candidate(f: Column) -> Column:
        values = {
            "phase": F.lit(PT.PHASE_SYNTAX), "rule_ord": F.lit(0), "pattern_ord": f["seq"], "match_ord": f["idx"],
            "column": F.lit(None), "confidence": F.lit(None),
        }
        return F.struct(*[(values[c.name] if c.name in values else f[c.name]).cast(c.dataType).alias(c.name) for c in CANDIDATE.fields])

    return F.transform(SY.found_in(), candidate)


def _first_of_each(found: Column, keep: str) -> tuple[Column, Column]:
    """The candidates in order, to be the column `ordered`, and of that the first of every line and rule."""
    key = lambda c: F.struct(c["line_number"].alias("line_number"), c["rule_id"].alias("rule_id"), severity_ranked(c, keep).alias("rank"), *[c[o].alias(o) for o in FINDING_ORDER], c.alias("c"))
    ordered = F.array_sort(F.transform(found, key))

    def is_first(x: Column, i: Column) -> Column:
        before = F.get(F.col("ordered"), i - 1)
        return (i == 0) | ~(before["line_number"].eqNullSafe(x["line_number"]) & (before["rule_id"] == x["rule_id"]))

    return ordered, F.transform(F.filter("ordered", is_first), lambda x: x["c"])


def analyze(files: DataFrame, patterns: list, detectors: tuple = (LINE, PYTHON), keep: str = "first", carried: tuple = ()) -> DataFrame:
    """One row per file: project_id, path, language, n_newlines, found (candidates with their line), problems, and the columns `carried`."""
    if keep not in ("first", "max_severity"):
        raise ValueError(f"keep must be 'first' or 'max_severity', not {keep!r}")
    text = F.col("text")
    rows = with_text(files.select("project_id", "path", "language", "content", *carried))
    rows = rows.withColumns({"lines": X.split_lines(text), "n_newlines": X.count_newlines(text)})
    missing = F.struct(F.lit("unreadable").alias("reason"), F.concat("path", F.lit(": no content")).alias("message"))
    problems, hits = [F.when(text.isNull(), missing)], []
    if LINE in detectors:
        literal = [p for p in patterns if isinstance(p, Pattern) and p.on_jvm]
        slow = [p for p in patterns if isinstance(p, Pattern) and not p.on_jvm]
        parts = [p for p in patterns if isinstance(p, TablePart)] + ([_python_part(files, slow)] if slow else [])
        hits += [literal_hits(literal)] if literal else []
        for i, part in enumerate(parts):
            rows = rows.withColumn(f"part{i}", part.hits(F.col("lines"), F.col("language")))
            hits.append(F.col(f"part{i}"))
    if PYTHON in detectors:
        rows = with_taint(rows.withColumn("facts", py_facts(F.when(F.col("language") == "python", text))))
        hits.append(_syntax_candidates())
        troubles = F.filter("facts", lambda f: f["kind"].isin("aborted", "error"))
        problems.append(F.get(F.transform(troubles, SY.problem_of), 0))
    none = F.array().cast(CANDIDATES)
    found = F.concat(*[F.coalesce(h.cast(CANDIDATES), none) for h in hits]) if hits else none
    ordered, kept = _first_of_each(found, keep)

    def with_line(c: Column) -> Column:
        line = F.coalesce(F.get(F.col("lines"), c["line_number"] - 1), F.lit(""))
        return F.struct(c.alias("c"), F.when(c["has_line"], X.strip(line)).alias("code_snippet"))

    rows = rows.withColumn("ordered", ordered).withColumn("kept", kept)
    return rows.select(
        "project_id", "path", "language", "n_newlines",
        F.transform("kept", with_line).alias("found"), F.array_compact(F.array(*problems)).cast(PROBLEMS).alias("problems"), *carried,
    )


def findings_of(analyzed: DataFrame) -> DataFrame:
    """One row per finding of analyzed files."""
    rows = analyzed.select("project_id", "path", F.explode(computed("found")).alias("x"))
    own = {"file_path": F.col("path"), "project_id": F.col("project_id"), "cwe_id": F.lit(None).cast("string"), "code_snippet": F.col("x.code_snippet")}
    names = ["project_id", "file_path", "line_number", "column", "rule_id", "severity", "message", "category", "cwe_id", "code_snippet", "confidence"]
    return rows.select(*[own.get(n, F.col(f"x.c.{n}")).alias(n) for n in names])


def problems_of(analyzed: DataFrame) -> DataFrame:
    """Error rows of files whose content is missing or whose syntax could not be followed."""
    return analyzed.select("project_id", "path", F.explode(computed("problems")).alias("p")).select("project_id", "path", "p.reason", "p.message")


def counts_of(analyzed: DataFrame) -> DataFrame:
    """Files, lines and triggered rules per project: sums of one small row per file and rule."""
    rules = F.array_distinct(F.transform("found", lambda x: x["c"]["rule_id"]))
    rows = analyzed.select("project_id", "n_newlines", F.posexplode_outer(rules).alias("pos", "rule_id"))
    first = F.coalesce("pos", F.lit(0)) == 0  # carries what the file counts for
    per_rule = rows.groupBy("project_id", "rule_id").agg(F.count_if(first).alias("n_files"), F.sum(F.when(first, F.col("n_newlines"))).alias("n_newlines"))
    return per_rule.groupBy("project_id").agg(
        F.sum("n_files").alias("files_analyzed"), F.sum("n_newlines").alias("total_lines_scanned"), F.count("rule_id").alias("rules_triggered")
    )
