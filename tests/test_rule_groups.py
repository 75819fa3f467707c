"""Rule tables whose rules share patterns: the findings of all parts and detectors, without a pass per rule."""

import pytest
from pyspark.sql import functions as F

from codesieve.operators import detectors as D
from codesieve.operators import rule_tables as RT
from codesieve.operators.inventory import with_language
from codesieve.operators.patterns import PHASE_RULES
from codesieve.plans import scan as SCAN

RULE = (
    "load_ord long, id string, severity string, category string, rule_type string, patterns array<string>, target_languages array<string>, "
    "case_sensitive boolean, multiline boolean, confidence_threshold double, description string"
)


def rules_of(spark):
    words, rows = [r"\bda\b", r"(unclosed", r"[xy]+$", r"\bdo\b", "", "K\\w"], []
    for i in range(90):
        patterns = [words[i % 6], words[i // 3 % 6], words[i // 7 % 6]][: i % 5]
        severity = ["LOW", "HIGH"][i % 2] if i > 60 else "LOW"
        rows.append((i, f"W{i % 40}" if i > 50 else f"W{i}", severity, "injection", "ast" if i % 11 == 0 else "regex", patterns, [["java"], [], ["python", "java"], None][i % 4], i % 7 == 0, None if i % 3 else False, 0.5, "a word"))
    return spark.createDataFrame(rows, RULE)


@pytest.mark.parametrize("keep", ["first", "max_severity"])
def test_groups_give_what_single_rules_give(spark, make_files, keep):
    files = with_language(make_files({"a.py": "da do\nDA xxy\n\nkx ſ K1 do da", "b.py": "", "c.java": "do\nK2 DO y", "d.js": "da"}))
    rules = rules_of(spark)
    single = SCAN.findings_of(files, RT.table_parts(rules, PHASE_RULES), (D.LINE_PATTERNS,), keep)
    columns = single.columns
    expected = sorted(map(str, single.collect()))
    for size in (RT.PART_BYTES, 3000):
        found = RT.table_findings(files, rules, PHASE_RULES, keep, part_bytes=size)
        assert sorted(map(str, found.select(*columns).collect())) == expected and expected
    assert RT.table_findings(files, rules.where("false"), PHASE_RULES).count() == 0


def test_rules_that_share_patterns_are_filed_once(spark, make_files):
    rules = spark.range(5000).select(
        F.col("id").alias("load_ord"), F.concat(F.lit("W"), "id").alias("id"), F.lit("LOW").alias("severity"), F.lit("injection").alias("category"),
        F.lit("regex").alias("rule_type"), F.array(F.concat(F.lit("\\bw"), (F.col("id") % 10).cast("string"))).alias("patterns"), F.array().cast("array<string>").alias("target_languages"),
        F.lit(False).alias("case_sensitive"), F.lit(False).alias("multiline"), F.lit(0.5).alias("confidence_threshold"), F.lit("a word").alias("description"),
    )
    groups, members = RT.rule_groups(rules)
    (matcher,) = RT.group_matchers(groups)
    assert len(matcher.value.expressions) == 10 and members.count() == 5000
    found = RT.table_findings(with_language(make_files({"a.py": "w1 w2\nw2"})), rules, PHASE_RULES)
    assert found.groupBy("line_number").count().orderBy("line_number").collect() == [(1, 1000), (2, 500)]
