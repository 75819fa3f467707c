"""Scope of rule tables: the index gives what the literal form gives."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codesieve.operators import rule_scope as RS
from codesieve.operators import rules as RU

GLOBS = ["*.py", "**.py", "src/*", "src/*.py", "*", "a?c.py", "[ab]*.py", "[!a]*.js", "Makefile", "x/Makefile", "f1*", "*test*", "é*.py", "a.py", "", "lib/*/z.*", "*.tar.gz", "[z"]
PATHS = ["a.py", "src/a.py", "src/b/a.py", "abc.py", "x/Makefile", "Makefile", "yMakefile", "f12.js", "x/f1", "my_test_z.js", "é1.py", "lib/q/z.py", "z.tar.gz", "b.PY", "[z", "line\nbreak.py", "src/"]
LANGUAGES = [None, "python", "javascript"]
RULE = "id string, load_ord bigint, enabled boolean, category string, target_languages array<string>, file_patterns array<string>, excluded_paths array<string>"


def rules_of(spark):
    rows = []
    for i, glob in enumerate(GLOBS):
        globs = [[glob], [glob, "*.js"], None][i % 3] if i % 5 else [glob]
        rows.append((f"R{i}", i, i % 4 != 3, ["a", "b"][i % 2], [[], ["python"], ["python", "javascript"], None][i % 4], globs, [[], ["src"], ["a", "z"]][i % 3]))
        rows.append((f"S{i}", 100 + i, True, "a", [], [glob], []))
    rows.append(("all", 900, True, "a", [], [], []))
    rows.append(("all", 901, True, "b", [], [], []))
    return spark.createDataFrame(rows, RULE)


def files_of(spark):
    rows = [("p", p, x) for p in [*PATHS, None] for x in LANGUAGES]
    return spark.createDataFrame(rows + rows[:2], "project_id string, path string, language string")


def listed(rows):
    return sorted(map(str, rows.select("project_id", "path", "language", "rule_id", "load_ord").collect()))


def test_index_equals_literals(spark):
    files, rules = files_of(spark), rules_of(spark)
    for categories in (None, ["b"]):
        literal = listed(RU.rules_for_files(files, rules, categories))
        assert listed(RS.rules_for_files(files, rules, categories)) == literal and literal
    # Scopes in many parts, and members that are too many for a broadcast.
    assert listed(RS.rules_for_files(files, rules, part_bytes=3000)) == listed(RU.rules_for_files(files, rules))
    assert listed(RS.rules_for_files(files, rules.where("false"))) == []
    assert listed(RS.rules_for_files(files.where("false"), rules)) == []


def test_totals_equal_the_counted_rows(spark):
    keys = ["project_id", "path", "language"]
    more = [(f"T{i}", 1000 + i, True, "a", [["python"], []][i % 2], ["*.py", f"f{i}*", "*"][: i % 4], ["src/", "", "b", f"f{i}"][i % 5 : i % 5 + 2]) for i in range(60)]
    files, rules = files_of(spark), rules_of(spark).unionByName(spark.createDataFrame(more, RULE))
    for categories, size in ((None, 1_000_000), (["b"], 1_000_000), (None, 3)):
        counted = RU.rules_for_files(files, rules, categories).groupBy(*keys).agg(F.count("*"), F.sum("load_ord"))
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(RS, "MEMBER_ROWS", size)
            totals = RS.rule_totals(files, rules, categories).groupBy(*keys).agg(F.sum("n_rules"), F.sum("sum_ord")).collect()
        assert sorted(map(tuple, totals), key=str) == sorted(map(tuple, counted.collect()), key=str) and totals
    assert RS.rule_totals(files, rules.where("false")).count() == 0


def test_totals_of_rules_that_share_a_glob_take_few_rows(spark):
    rules = spark.range(3000).select(
        F.concat(F.lit("R"), "id").alias("id"), F.col("id").alias("load_ord"), F.lit(True).alias("enabled"), F.lit("a").alias("category"),
        F.array().cast("array<string>").alias("target_languages"), F.array(F.concat(F.lit("f"), "id", F.lit(".*")), F.lit("*.css")).alias("file_patterns"),
        F.array(F.lit("src/"), F.concat(F.lit("f"), "id")).alias("excluded_paths"),
    )
    scopes = RS.scoped(rules).groupBy("scope").agg(*[F.first(n).alias(n) for n in RS.TESTS], F.count("*").alias("n_rules"), F.sum("load_ord").alias("sum_ord"))
    per_key = RS._nodes(scopes).groupBy("language", "glob", "part").count().agg(F.max("count")).first()[0]
    assert per_key == 1
    files = spark.createDataFrame([("p", "a/f7.css", "css"), ("p", "src/f7.css", "css"), ("p", "f8.py", "python")], "project_id string, path string, language string")
    assert [tuple(r)[1:] for r in RS.rule_totals(files, rules).collect()] == [("a/f7.css", "css", 2999, sum(range(3000)) - 7)]


def test_members_beyond_the_bound_are_joined_without_a_hint(spark, monkeypatch):
    monkeypatch.setattr(RS, "MEMBER_ROWS", 3)
    found = RS.rules_for_files(files_of(spark), rules_of(spark))
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()
    assert listed(found) == listed(RU.rules_for_files(files_of(spark), rules_of(spark)))


def test_plan_does_not_grow_with_the_rules(spark):
    files = files_of(spark)
    plans = []
    for n in (300, 3000):
        rules = spark.range(n).select(
            F.concat(F.lit("R"), "id").alias("id"), F.col("id").alias("load_ord"), F.lit(True).alias("enabled"), F.lit("a").alias("category"),
            F.array().cast("array<string>").alias("target_languages"), F.array(F.concat(F.lit("f"), "id", F.lit("*.py"))).alias("file_patterns"), F.array().cast("array<string>").alias("excluded_paths"),
        )
        found = RU.rules_for_files(files, rules)
        assert found.count() == 0
        plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert plans[0] == plans[1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab/.*?[]!", max_size=6), max_size=4), st.text("ab/.", max_size=8))
def test_lookup_equals_all_expressions(globs, path):
    import re

    def matches(glob):
        return re.search(RS.python_regex(glob), path) is not None

    def compiles(glob):
        try:
            re.compile(RS.python_regex(glob))
        except re.error:
            return False
        return True

    globs = [g for g in globs if compiles(g)]
    index = RS.ScopeIndex([(str(i), (), (g,), ()) for i, g in enumerate(globs)])
    assert index.of(path, None) == [str(i) for i, g in enumerate(globs) if matches(g)]
