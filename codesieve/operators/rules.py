"""Rule tables: scope, catalogue filters, statistics, validation, upsert and set operations.

Scope tests run the rule rows as literals of one projection over the file or project
table, in blocks, instead of joining every file with every rule.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions.paths import any_glob
from codesieve.operators import rule_scope as RS

BLOCK = 200


def _unroll(table: DataFrame, rules: DataFrame, test) -> DataFrame:
    """Rows of `table`, once per rule that passes `test(rule)`, with rule_id and load_ord."""
    rows = list(
        rules.orderBy("load_ord")
        .select(
            "id", "load_ord", "enabled", "category", "target_languages", "file_patterns",
            "excluded_paths",
        )
        .toLocalIterator()
    )
    none = F.struct(F.lit("").alias("rule_id"), F.lit(0).cast("bigint").alias("load_ord"))
    parts = []
    for start in range(0, max(len(rows), 1), BLOCK):
        hits = [
            F.when(
                test(r),
                F.struct(
                    F.lit(r.id).alias("rule_id"), F.lit(r.load_ord).cast("bigint").alias("load_ord")
                ),
            )
            for r in rows[start : start + BLOCK]
        ] or [F.when(F.lit(False), none)]
        parts.append(
            table.select("*", F.explode(F.array_compact(F.array(*hits))).alias("r")).select(
                *table.columns, "r.*"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def rules_for_projects(projects: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules of each project: those without languages, or sharing one with its targets."""

    def test(rule) -> Column:
        if not rule.target_languages:
            return F.lit(True)
        mine = F.array(*[F.lit(x) for x in rule.target_languages])
        return F.arrays_overlap("target_languages", mine)

    return _unroll(projects, rules, test)


def rules_for_language(rules: DataFrame, languages: list[str]) -> DataFrame:
    """Rules an analyzer of these languages applies."""
    mine = F.array(*[F.lit(x) for x in languages])
    return rules.where(
        (F.size("target_languages") == 0) | F.arrays_overlap("target_languages", mine)
    )


def rules_for_files(
    files: DataFrame, rules: DataFrame, categories: list[str] | None = None
) -> DataFrame:
    """Full scope: enabled, language, file globs, excluded substrings and enabled categories.

    Some rules are literals of the plan; a table of more than BLOCK rules becomes an index of scopes, with the same rows.
    """
    if rules.limit(BLOCK + 1).count() > BLOCK:
        return RS.rules_for_files(files, rules, categories)

    def test(rule) -> Column:
        if not rule.enabled or (categories is not None and rule.category not in categories):
            return F.lit(False)
        ok = F.lit(True)
        if rule.target_languages:
            ok = ok & F.col("language").isin(*rule.target_languages)
        if rule.file_patterns:
            ok = ok & any_glob(F.col("path"), list(rule.file_patterns))
        for part in rule.excluded_paths or []:
            ok = ok & ~F.contains("path", F.lit(part))
        return ok

    return _unroll(files, rules, test)


def filter_catalog(
    rules: DataFrame,
    category: str | None = None,
    language: str | None = None,
    severity: str | None = None,
    enabled_only: bool = False,
) -> DataFrame:
    out = rules
    if category:
        out = out.where(F.contains(F.lower("category"), F.lit(category.lower())))
    if language:
        out = out.where(F.exists("target_languages", lambda x: F.lower(x) == language.lower()))
    if severity:
        out = out.where(F.col("severity") == severity)
    if enabled_only:
        out = out.where("enabled")
    return out


def rule_stats(rules: DataFrame) -> DataFrame:
    """Counts in total and by category, severity and type, in one grouping-sets pass."""
    dims = ["category", "severity", "rule_type"]
    grouped = rules.groupingSets(
        [[], ["category"], ["severity"], ["rule_type"]], *dims
    ).agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("total"),
        F.count_if("enabled").alias("enabled"),
    )
    kind = F.when(F.col("level") == 7, "all")
    for dim, level in zip(dims, (3, 5, 6)):
        kind = kind.when(F.col("level") == level, dim)
    return grouped.select(
        kind.alias("dimension"),
        F.coalesce(*dims, F.lit("all")).alias("value"),
        "total",
        "enabled",
        (F.col("total") - F.col("enabled")).alias("disabled"),
    )


def catalog_counts(rules: DataFrame) -> DataFrame:
    """Rules by category, severity and (multi-valued) language."""
    entry = lambda kind, value: F.struct(F.lit(kind).alias("dimension"), value.alias("value"))
    facets = F.concat(
        F.array(entry("category", F.col("category")), entry("severity", F.col("severity"))),
        F.transform("target_languages", lambda x: entry("language", x)),
    )
    return (
        rules.select(F.explode(facets).alias("f"))
        .groupBy("f.dimension", "f.value")
        .agg(F.count("*").alias("n"))
    )


# --- validation -------------------------------------------------------------------------


def rule_issues(rules: DataFrame) -> DataFrame:
    """Errors and warnings of a rule table. An id that occurs n times gives n-1 errors."""
    repeats = (
        rules.groupBy("id")
        .agg((F.count("*") - 1).alias("extra"))
        .where("extra > 0")
        .select("id", F.explode(F.array_repeat(F.lit("duplicate_id"), F.col("extra").cast("int"))).alias("issue"))
    )
    fields = rules.select(
        "id",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.coalesce(F.size("patterns"), F.lit(0)) <= 0, "no_patterns"),
                    F.when(F.coalesce("metadata.cwe_id", F.lit("")) == "", "no_cwe"),
                )
            )
        ).alias("issue"),
    )
    text = {
        "duplicate_id": vocab.MSG_DUPLICATE_ID,
        "no_patterns": vocab.MSG_NO_PATTERNS,
        "no_cwe": vocab.MSG_NO_CWE,
    }
    message = None
    for issue, form in text.items():
        said = F.format_string(form, "id")
        test = F.col("issue") == issue
        message = F.when(test, said) if message is None else message.when(test, said)
    return repeats.unionByName(fields).select(
        "id",
        F.when(F.col("issue") == "no_cwe", "warning").otherwise("error").alias("level"),
        "issue",
        message.alias("message"),
    )


def validation_report(rules: DataFrame) -> DataFrame:
    """One row: totals, duplicate ids, errors and warnings. Every rule that can be read counts
    as valid, as published; n_with_errors tells how many ids have an error."""
    every = rules.select("id", F.lit("rule").alias("level"), F.lit(None).cast("string").alias("issue"))
    issues = rule_issues(rules).select("id", "level", "issue").unionByName(every)
    return issues.agg(
        F.count_if(F.col("level") == "rule").alias("total_rules"),
        F.count_if(F.col("issue") == "duplicate_id").alias("n_duplicates"),
        F.count_if(F.col("level") == "error").alias("n_errors"),
        F.count_if(F.col("level") == "warning").alias("n_warnings"),
        F.count_distinct(F.when(F.col("level") == "error", F.col("id"))).alias("n_with_errors"),
    ).select(
        "total_rules",
        F.col("total_rules").alias("valid_rules"),
        F.lit(0).cast("bigint").alias("invalid_rules"),
        "n_duplicates",
        "n_errors",
        "n_warnings",
        "n_with_errors",
    )


def duplicate_ids(rules: DataFrame) -> DataFrame:
    return rules.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


# --- set operations -----------------------------------------------------------------------


def upsert(rules: DataFrame) -> DataFrame:
    """Last rule of every id wins; the id keeps the place where it first appeared."""
    fields = [c for c in rules.columns if c not in ("id", "load_ord")]
    return (
        rules.groupBy("id")
        .agg(
            F.max_by(F.struct(*fields), "load_ord").alias("r"),
            F.min("load_ord").alias("load_ord"),
        )
        .select("id", "r.*", "load_ord")
        .select(*rules.columns)
    )


def combine(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union of rule tables in order, later tables winning on equal ids."""
    both = first
    for more in others:
        top = both.agg(F.coalesce(F.max("load_ord") + 1, F.lit(0)).alias("top"))
        both = both.unionByName(more.withColumn("load_ord", F.col("load_ord") + top.scalar()))
    return upsert(both)


def remove(rules: DataFrame, ids: DataFrame) -> DataFrame:
    return rules.join(ids.select("id"), "id", "left_anti").select(*rules.columns)


def get(rules: DataFrame, rule_id: str) -> DataFrame:
    return rules.where(F.col("id") == rule_id)


def of_category(rules: DataFrame, category: str) -> DataFrame:
    return rules.where(F.col("category") == category)
