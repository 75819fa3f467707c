"""Detectors over Python syntax facts: dangerous calls, system calls, SQL, secrets, errors.

Everything about one file happens inside its row; rows are produced only for findings.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from codesieve import vocab
from codesieve.functions import regex as R
from codesieve.functions import text as X
from codesieve.functions.arrays import computed
from codesieve.functions.pyfacts import py_facts
from codesieve.operators.lines import with_text
from codesieve.operators.patterns import PHASE_SYNTAX
from codesieve.operators.taint import with_taint
from codesieve.schemas import SYNTAX_FINDING

def extract_facts(files: DataFrame) -> DataFrame:
    """(project_id, path, lines, facts) of Python files."""
    return (
        with_text(files)
        .select("project_id", "path", "text")
        .withColumn("facts", py_facts("text"))
        .withColumn("lines", X.split_lines(F.col("text")))
        .drop("text")
    )


def facts_table(facts: DataFrame) -> DataFrame:
    """One row per fact."""
    return facts.select("project_id", "path", F.explode(computed("facts")).alias("f")).select(
        "project_id", "path", "f.*"
    )


def taint_table(facts: DataFrame) -> DataFrame:
    """One row per tainted variable of a file, with the place where it became tainted."""
    return (
        with_taint(facts)
        .select("project_id", "path", F.explode(computed("taint")).alias("t"))
        .select("project_id", "path", "t.*")
    )


def call_class(name: Column) -> Column:
    """What a call is checked for; the first that applies."""
    sql = F.lit(False)
    for part in vocab.SQL_NAME_PARTS:
        sql = sql | F.contains(name, F.lit(part))
    return (
        F.when(name.isin(*vocab.DANGEROUS_FUNCTIONS), "dangerous")
        .when(name.isin(*vocab.SYSTEM_CALLS), "system")
        .when(sql, "sql")
        .when(name.isin(*vocab.TAINT_SOURCES), "source")
    )


def has_concatenation(call: Column) -> Column:
    """A '+' argument with a constant or a name on one side, or any '+' keyword argument."""
    return F.exists(call["args"], lambda a: a["is_add"] & a["plain_side"]) | call["kw_add"]


def _finding(f: Column, idx, rule_id, severity, message, category, has_line=True) -> Column:
    return F.struct(
        f["lineno"].alias("line_number"),
        rule_id.alias("rule_id"),
        f["seq"].alias("seq"),
        F.lit(idx).alias("idx") if isinstance(idx, int) else idx.alias("idx"),
        severity.alias("severity"),
        message.alias("message"),
        F.lit(category).alias("category"),
        F.lit(has_line).alias("has_line"),
    )


def _call_findings(f: Column, tainted: Column) -> Column:
    name, kind = f["name"], call_class(f["name"])

    def raised(base: str) -> Column:
        return F.when(tainted, "CRITICAL").otherwise(base)

    dangerous = _finding(
        f, 0, F.concat(F.lit("DANGEROUS_FUNCTION_"), F.upper(name)), raised("HIGH"),
        F.format_string(vocab.MSG_DANGEROUS, name), "dangerous_functions",
    )
    system = _finding(
        f, 0, F.lit("COMMAND_INJECTION_001"), raised("MEDIUM"),
        F.format_string(vocab.MSG_COMMAND, name), "injection",
    )
    sql = _finding(
        f, 0, F.lit("SQL_INJECTION_001"), raised("HIGH"),
        F.format_string(vocab.MSG_SQL, name), "injection",
    )
    suspicious = F.coalesce(has_concatenation(f), F.lit(False)) | tainted | f["line_concat"]
    return (
        F.when(kind == "dangerous", F.array(dangerous))
        .when(kind == "system", F.array(system))
        .when((kind == "sql") & suspicious, F.array(sql))
        .otherwise(_none())
    )


def _secret_names(f: Column) -> Column:
    """One finding per assigned name that sounds secret."""
    test = F.lit("|".join(f"(?:{R.to_java(p)})" for p in vocab.SECRET_NAMES))
    named = F.transform(
        f["targets"],
        lambda name, i: F.when(
            F.rlike(name, test),
            _finding(
                f, i, F.lit("HARDCODED_SECRET_001"), F.lit("HIGH"),
                F.format_string(vocab.MSG_SECRET_NAME, name), "hardcoded_secrets",
            ),
        ),
    )
    return F.when(f["value"] == "str", F.array_compact(named)).otherwise(_none())


def secret_kind(text: Column) -> Column:
    kind = None
    for name, pattern in vocab.SECRET_STRINGS:
        test = F.rlike(text, F.lit(R.with_flags(pattern, True, False, unicode=True)))
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    return kind


def _secret_strings(f: Column) -> Column:
    kind = secret_kind(f["text"])
    return F.filter(
        F.array(
            _finding(
                f, 0, F.concat(F.lit("HARDCODED_"), kind, F.lit("_001")), F.lit("MEDIUM"),
                F.format_string(vocab.MSG_SECRET_STRING, F.lower(kind)), "hardcoded_secrets",
            )
        ),
        lambda x: x["rule_id"].isNotNull(),
    )


def _none() -> Column:
    return F.array().cast(ArrayType(SYNTAX_FINDING))


def _findings_of(f: Column, tainted: Column) -> Column:
    kind = f["kind"]
    syntax = _finding(
        f, 0, F.lit("SYNTAX_ERROR"), F.lit("LOW"),
        F.format_string(vocab.MSG_SYNTAX, f["text"]), "syntax", has_line=False,
    )
    return (
        F.when(kind == "call", _call_findings(f, tainted))
        .when(kind == "assign", _secret_names(f))
        .when(kind == "str", _secret_strings(f))
        .when(kind == "syntax_error", F.array(syntax))
        .otherwise(_none())
    ).cast(ArrayType(SYNTAX_FINDING))


def found_in() -> Column:
    """All findings of the columns `facts` and `flags` as one array."""
    return F.flatten(F.transform("facts", lambda f, i: _findings_of(f, F.get(F.col("flags"), i))))


def detect(facts: DataFrame) -> DataFrame:
    """(project_id, path, lines, found): all findings of a file as one sorted array."""
    return with_taint(facts).select(
        "project_id", "path", "lines", "flags", F.array_sort(found_in()).alias("found")
    ).drop("flags")


def all_syntax_findings(facts: DataFrame) -> DataFrame:
    """Every finding before de-duplication, without its line."""
    return (
        detect(facts)
        .select("project_id", F.col("path").alias("file_path"), F.explode(computed("found")).alias("f"))
        .select("project_id", "file_path", "f.*")
        .drop("has_line")
    )


def syntax_findings(facts: DataFrame) -> DataFrame:
    """Findings of Python files, the first per (line, rule) kept inside the row of the file,
    so that a line's text is copied at most once per rule."""

    def is_first(x: Column, i: Column) -> Column:
        before = F.get(F.col("found"), i - 1)
        same = before["line_number"].eqNullSafe(x["line_number"]) & (
            before["rule_id"] == x["rule_id"]
        )
        return (i == 0) | ~same

    def with_line(x: Column) -> Column:
        line = F.coalesce(F.get(F.col("lines"), x["line_number"] - 1), F.lit(""))
        return F.struct(x.alias("f"), F.when(x["has_line"], line).alias("line"))

    kept = F.transform(F.filter("found", is_first), with_line)
    return (
        detect(facts)
        .select("project_id", "path", F.explode(kept).alias("x"))
        .select(
            "project_id",
            F.col("path").alias("file_path"),
            F.col("x.f.line_number").alias("line_number"),
            F.lit(None).cast("int").alias("column"),
            F.col("x.f.rule_id").alias("rule_id"),
            F.col("x.f.severity").alias("severity"),
            F.col("x.f.message").alias("message"),
            F.col("x.f.category").alias("category"),
            F.lit(None).cast("string").alias("cwe_id"),
            X.strip(F.col("x.line")).alias("code_snippet"),
            F.lit(None).cast("double").alias("confidence"),
            F.lit(PHASE_SYNTAX).alias("phase"),
            F.lit(0).alias("rule_ord"),
            F.col("x.f.seq").alias("pattern_ord"),
            F.col("x.f.idx").alias("match_ord"),
        )
    )


def problem_of(f: Column) -> Column:
    """(reason, message) of a fact that tells of a file that could not be followed (too deep for the
    parser), or of a failure while following it."""
    failed = f["kind"] == "error"
    return F.struct(
        F.when(failed, "analysis_error").otherwise("syntax_aborted").alias("reason"),
        F.when(failed, F.format_string(vocab.MSG_ANALYSIS_ERROR, f["text"])).otherwise(f["text"]).alias("message"),
    )


def fact_errors(facts: DataFrame) -> DataFrame:
    """Error rows of files whose syntax could not be followed."""
    troubles = F.filter("facts", lambda f: f["kind"].isin("aborted", "error"))
    rows = facts.select("project_id", "path", F.explode(F.transform(troubles, problem_of)).alias("p"))
    return rows.select("project_id", "path", "p.reason", "p.message")
