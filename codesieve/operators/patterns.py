"""Lines x patterns: the central regex join, as one narrow projection per pattern block.

Pattern text is a literal of the plan, so the JVM compiles it once per task, and a
substring test on the pattern's anchors stands before every regex. Lines are never
shuffled and never multiplied by the pattern table; only hits become rows.
"""

import re
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType

from codesieve import packs
from codesieve.functions import regex as R
from codesieve.functions import text as X
from codesieve.functions.arrays import computed
from codesieve.functions.literals import quote
from codesieve.operators.rule_tables import TablePart, table_parts
from codesieve.schemas import SPANS

# Rule tables of more patterns are matched by an automaton.
LITERAL_PATTERNS = 200
# Patterns unrolled into one projection. More patterns mean more passes, never fewer patterns.
BLOCK = 200

PHASE_BUILTIN, PHASE_RULES, PHASE_SYNTAX = 0, 1, 2


@dataclass(frozen=True)
class Pattern:
    phase: int
    rule_ord: int
    pattern_ord: int
    rule_id: str
    text: str
    ignore_case: bool
    multiline: bool
    languages: tuple
    severity: str
    message: str
    category: str
    confidence: float | None
    on_jvm: bool = True

    @property
    def java(self) -> str:
        return R.with_flags(self.text, self.ignore_case, self.multiline, unicode=True)

    @property
    def flags(self) -> int:
        return (re.I if self.ignore_case else 0) | (re.M if self.multiline else 0)


def builtin_patterns() -> list[Pattern]:
    return [
        Pattern(
            PHASE_BUILTIN, rule_ord, pattern_ord, rule["id"], text, True, True, ("python",),
            rule["severity"], rule["message"], rule["category"], None,
        )
        for rule_ord, rule in enumerate(packs.BUILTIN_PATTERNS)
        for pattern_ord, text in enumerate(rule["patterns"])
    ]


def shipped_patterns() -> list[Pattern]:
    """Patterns of the packaged rules, which need no Spark job to load."""
    rules = [r for r in packs.SHIPPED_RULES if r["rule_type"] == "regex"]
    return [
        Pattern(
            PHASE_RULES, rule_ord, pattern_ord, r["id"], text, not r["case_sensitive"], False,
            tuple(r["target_languages"]), r["severity"], r["description"], r["category"],
            r["confidence_threshold"],
        )
        for rule_ord, r in enumerate(rules)
        for pattern_ord, text in enumerate(r["patterns"])
    ]


def compiled_rules(rules: DataFrame) -> list:
    """The rules as literal patterns of the plan; a table of more than LITERAL_PATTERNS patterns as parts of an automaton."""
    n = rules.where("rule_type = 'regex'").agg(F.sum(F.size("patterns"))).first()[0] or 0
    return rule_patterns(rules) if n <= LITERAL_PATTERNS else table_parts(rules, PHASE_RULES)


def rule_patterns(rules: DataFrame) -> list[Pattern]:
    """Usable patterns of the regex rules, in load order. Bad patterns are left out.

    The patterns become part of the plan: for small rule sets, see `compiled_rules`.
    """
    rows = (
        rules.where(F.col("rule_type") == "regex")
        .orderBy("load_ord")
        .select(
            "load_ord", "id", "patterns", "case_sensitive", "multiline", "target_languages",
            "severity", "description", "category", "confidence_threshold",
        )
        .toLocalIterator()
    )
    found = [
        Pattern(
            PHASE_RULES, rule_ord, pattern_ord, r.id, text, not r.case_sensitive,
            bool(r.multiline), tuple(r.target_languages or ()), r.severity, r.description,
            r.category, r.confidence_threshold,
        )
        for rule_ord, r in enumerate(rows)
        for pattern_ord, text in enumerate(r.patterns)
        if R.pattern_error(text) is None
    ]
    return _choose_engine(found)


def _choose_engine(patterns: list[Pattern]) -> list[Pattern]:
    """Patterns Java rejects, or that may match the empty string, are matched by Python's re."""
    sure = [not R.matches_empty(p.text) for p in patterns]
    accepted = iter(R.jvm_accepts([p.java for p, ok in zip(patterns, sure) if ok]))
    return [
        Pattern(**{**p.__dict__, "on_jvm": ok and next(accepted)}) for p, ok in zip(patterns, sure)
    ]


def pattern_rejects(rules: DataFrame) -> DataFrame:
    """Patterns that do not compile, with the reason."""

    check = R.pattern_error

    @F.arrow_udf(StringType())
    def reason(texts: pa.Array) -> pa.Array:
        return pa.array([check(t) for t in texts.to_pylist()], pa.string())

    return (
        rules.where(F.col("rule_type") == "regex")
        .select("id", F.posexplode("patterns").alias("pattern_ord", "pattern"))
        .withColumn("reason", reason("pattern"))
        .where(F.col("reason").isNotNull())
    )


def _folded(line: Column) -> Column:
    """Lower case, with the four letters that case-insensitive matching ties to ASCII ones."""
    return F.when(X.is_ascii(line), F.lower(line)).otherwise(
        F.lower(F.translate(line, "ſKİı", "skii"))
    )


def _has_anchor(patterns: list[Pattern]) -> str:
    """SQL test that is false only where none of the patterns can match."""
    words = set()
    for p in patterns:
        if not R.anchors(p.text):
            return "true"
        words.update(R.anchors(p.text))
    shortest = [w for w in words if not any(o != w and o in w for o in words)]
    return "(" + " OR ".join(f"contains(folded, {quote(w)})" for w in sorted(shortest)) + ")"


def _test(p: Pattern) -> str:
    tests = []
    if p.languages:
        tests.append("language IN (" + ", ".join(quote(x) for x in p.languages) + ")")
    tests.append(_has_anchor([p]))
    if p.on_jvm:
        tests.append(f"rlike(line, {quote(p.java)})")
    return " AND ".join(tests)


def _explode_hits(lines: DataFrame, patterns: list[Pattern], hits: list[str]) -> DataFrame:
    """Lines times hits, where `hits` are SQL structs or NULL, in one pass for any number of them.

    Blocks of hits are arrays of their own, so that no generated method grows with the rule set.
    The gate is part of the generator: as a filter it would be pushed below `folded`,
    which then would be computed once per anchor.
    """
    folded = lines.withColumn("folded", _folded(F.col("line")))
    blocks = [f"array({', '.join(hits[i : i + BLOCK])})" for i in range(0, len(hits), BLOCK)]
    found = F.expr(f"CASE WHEN {_has_anchor(patterns)} THEN array_compact(concat({', '.join(blocks)})) END")
    return folded.select(*lines.columns, F.explode(found).alias("hit")).select(
        *lines.columns, "hit.*"
    )


def _rules_of(patterns: list[Pattern]) -> list[list[Pattern]]:
    grouped: dict = {}
    for p in patterns:
        grouped.setdefault((p.phase, p.rule_ord), []).append(p)
    return list(grouped.values())


def _describe(hits: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """Add the fields of the rule; `rule` is its place among the rules of the patterns."""
    rows = []
    for rule in _rules_of(patterns):
        p = rule[0]
        rows.append(
            f"struct({p.phase} AS phase, {p.rule_ord} AS rule_ord, {quote(p.rule_id)} AS rule_id, "
            f"{quote(p.severity)} AS severity, {quote(p.message)} AS message, "
            f"{quote(p.category)} AS category, CAST({quote(p.confidence)} AS DOUBLE) AS confidence)"
        )
    kept = [c for c in hits.columns if c != "rule"]
    table = F.expr(f"array({', '.join(rows)})")
    return hits.withColumn("r", F.get(table, F.col("rule"))).select(*kept, "r.*")


def _part_matches(lines: DataFrame, part: TablePart) -> DataFrame:
    own = ["pattern_ord", "match_ord", "column", "phase", "rule_ord", "rule_id", "severity", "message", "category", "confidence"]
    hits = lines.select(*lines.columns, F.explode(computed(part.hits(F.array("line"), F.col("language")))).alias("hit"))
    return hits.select(*lines.columns, *[F.col(f"hit.{c}").alias(c) for c in own])


def first_matches(lines: DataFrame, patterns: list) -> DataFrame:
    """The finding each rule keeps on each line: its first pattern in list order that hits.

    This is the part of keep-first de-duplication that needs no other row. `patterns` has literal patterns and parts of
    rule tables; each part is a pass.
    """
    outputs = [_part_matches(lines, p) for p in patterns if isinstance(p, TablePart)]
    patterns = [p for p in patterns if isinstance(p, Pattern)]
    fast, hits = [p for p in patterns if p.on_jvm], []
    for i, rule in enumerate(_rules_of(fast)):
        whens = " ".join(
            f"WHEN {_test(p)} THEN struct({i} AS rule, {p.pattern_ord} AS pattern_ord, "
            f"0 AS match_ord, char_length(split(line, {quote(p.java)}, 2)[0]) + 1 AS column)"
            for p in rule
        )
        hits.append(f"CASE {whens} END")
    if hits:
        outputs.append(_describe(_explode_hits(lines, fast, hits), fast))
    rest = [p for p in patterns if not p.on_jvm]
    if rest or not outputs:
        found = all_matches(lines, rest or builtin_patterns())
        outputs.append(
            found.where("match_ord = 0" if rest else "false").drop(
                "start_column", "end_column", "matched_text"
            )
        )
    return reduce(DataFrame.unionByName, outputs)


def all_matches(lines: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """Every match of every pattern with its span (code points, end exclusive).

    The JVM finds the (line, pattern) hits; only those are searched for spans.
    """
    arrow_type = to_arrow_type(SPANS)

    @F.arrow_udf(SPANS)
    def spans(line: pa.Array, pattern: pa.Array, flags: pa.Array) -> pa.Array:
        out = []
        for text, source, flag in zip(line.to_pylist(), pattern.to_pylist(), flags.to_pylist()):
            out.append(
                [
                    {"start": m.start(), "stop": m.end(), "matched_text": m.group()}
                    for m in re.finditer(source, text, flag)
                ]
            )
        return pa.array(out, arrow_type)

    place = {id(p): i for i, rule in enumerate(_rules_of(patterns)) for p in rule}
    tests = [
        f"CASE WHEN {_test(p)} THEN struct({place[id(p)]} AS rule, {p.pattern_ord} AS pattern_ord, "
        f"{quote(p.text)} AS pattern, {int(p.flags)} AS flags) END"
        for p in patterns
    ]
    hits = _describe(_explode_hits(lines, patterns, tests), patterns)
    return (
        hits.withColumn("spans", spans("line", "pattern", "flags"))
        .select("*", F.posexplode(computed("spans")).alias("match_ord", "span"))
        .withColumn("column", F.col("span.start") + 1)
        .withColumn("start_column", F.col("span.start"))
        .withColumn("end_column", F.col("span.stop"))
        .withColumn("matched_text", F.col("span.matched_text"))
        .drop("spans", "span", "pattern", "flags")
    )


def match_records(matches: DataFrame) -> DataFrame:
    """Matches with the span record of the data model nested under `match`."""
    return matches.select(
        "*",
        F.struct(
            F.col("line_number").alias("start_line"),
            F.col("line_number").alias("end_line"),
            "start_column",
            "end_column",
            "matched_text",
            F.coalesce("confidence", F.lit(1.0)).alias("confidence"),
        ).alias("match"),
    )


def to_findings(hits: DataFrame) -> DataFrame:
    """Hit rows to findings with their detection order; the snippet is the stripped line."""
    return hits.select(
        "project_id",
        F.col("path").alias("file_path"),
        "line_number",
        F.col("column").cast("int").alias("column"),
        "rule_id",
        "severity",
        "message",
        "category",
        F.lit(None).cast("string").alias("cwe_id"),
        X.strip(F.col("line")).alias("code_snippet"),
        "confidence",
        "phase",
        "rule_ord",
        "pattern_ord",
        "match_ord",
    )
