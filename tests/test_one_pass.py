"""One pass per file, rule tables as an automaton, and lookups that leave the text where it is."""

import pickle
import random
import re

import pytest
from pyspark.sql import functions as F

from codesieve.functions import regex as R
from codesieve.operators import detectors as D
from codesieve.operators import file_pass as FP
from codesieve.operators import findings as FD
from codesieve.operators import lines as L
from codesieve.operators import patterns as PT
from codesieve.operators import rule_tables as RT
from codesieve.operators.inventory import with_language
from codesieve.plans import scan as SCAN

RULE = (
    "load_ord bigint, id string, severity string, category string, rule_type string, patterns array<string>, target_languages array<string>, "
    "case_sensitive boolean, multiline boolean, confidence_threshold double, description string"
)
PARTS = ["password", "eval(", "x = ", "ſecret", "KELVIN", "İ", "token: 'abc'", "import os", " ", "é", "9" * 12, "DEBUG = True", "\t"]
TEXTS = [
    ["passw[o0]rd"], ["(unclosed", "eval\\("], ["(?i)secret|kelvin"], ["^\\s*$"], ["[0-9]{10}"], ["(?P<a>[a-z])(?P=a)"], ["token.{0,5}abc"], ["x*"],
    ["nothing here", "import\\s+os"], ["(?<=x )="], ["debug"], ["\\Ax"], ["é"], ["i"], [], [None],
]


def rule_rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (i, f"R{i}", rng.choice(["HIGH", "LOW", "CRITICAL"]), "injection", rng.choice(["regex"] * 5 + ["ast"]), rng.choice(TEXTS) + rng.choice(TEXTS),
         rng.choice([[], ["python"], ["javascript", "java"], None]), rng.choice([True, False, None]), rng.choice([True, False]), rng.choice([0.5, None]), f"about {i}")
        for i in range(n)
    ]


def sources(seed=2):
    rng = random.Random(seed)
    return {f"f{i}.{rng.choice(['py', 'py', 'js'])}": "\n".join("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 12))) for i in range(25)}


def brute_hits(files, rules):
    """(path, line, rule, pattern, column) by plain loops."""
    out = set()
    for path, text in files.items():
        language = "python" if path.endswith(".py") else "javascript"
        for n, line in enumerate(text.splitlines(), 1):
            for r in rules:
                if r[4] != "regex" or (r[6] and language not in r[6]):
                    continue
                for k, p in enumerate(r[5]):
                    if p is None or R.pattern_error(p):
                        continue
                    m = re.search(p, line, (0 if r[7] else re.I) | (re.M if r[8] else 0))
                    if m:
                        out.add((path, n, r[1], k, m.start() + 1))
                        break
    return out


@pytest.mark.parametrize("part_bytes", [RT.PART_BYTES, 5_000])
def test_rule_table_equals_plain_loops(spark, make_files, part_bytes):
    files, rows = sources(), rule_rows(60)
    parts = RT.table_parts(spark.createDataFrame(rows, RULE), PT.PHASE_RULES, part_bytes)
    assert (len(parts) > 1) == (part_bytes < RT.PART_BYTES)
    table = with_language(make_files(files))
    want = brute_hits(files, rows)
    lines = L.explode_lines(table, "project_id", "path", "language")
    by_line = PT.first_matches(lines, parts).select("path", "line_number", "rule_id", "pattern_ord", "column").collect()
    assert len(by_line) == len(set(by_line)) and {tuple(r) for r in by_line} == want and want
    found = SCAN.findings_of(table, parts, (D.LINE_PATTERNS,)).select("file_path", "line_number", "rule_id", "column").collect()
    assert sorted(map(tuple, found)) == sorted((p, n, r, c) for p, n, r, _, c in want)


def test_plan_does_not_grow_with_the_rules(spark, make_files):
    files = with_language(make_files({"a.py": "word5 = 1\nword77\n"}))
    sizes = []
    for n in (300, 3000):
        rows = [(i, f"R{i}", "LOW", "c", "regex", [f"\\bword{i}\\b"], [], False, False, 0.5, "d") for i in range(n)]
        patterns = PT.compiled_rules(spark.createDataFrame(rows, RULE))
        assert [type(p) for p in patterns] == [RT.TablePart]
        found = SCAN.findings_of(files, patterns)
        sizes.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
        assert {r.rule_id for r in found.collect()} == {"R5", "R77"}
    assert abs(sizes[0] - sizes[1]) < 100


def test_matcher_survives_pickling():
    rows = [RT.TablePattern(1, i, 0, f"R{i}", f"\\bw{i}\\b", re.I, (), "LOW", "m", "c", None, (f"w{i}",)) for i in range(50)]
    matcher = pickle.loads(pickle.dumps(RT.Matcher(rows)))
    assert [(p.rule_id, c) for p, c in matcher.first_hits("a W7 and w31 w7", "python")] == [("R7", 3), ("R31", 10)]
    assert list(RT.Matcher([]).first_hits("w7", "python")) == []


def troubled(make_files):
    files = with_language(make_files({
        **sources(),
        "broken.py": "def broken(\npassword = 'abcdef12'\n", "deep.py": "x = " + "-" * 100_000 + "1\n", "empty.py": "",
        "taint.py": 'x = input("q")\neval(x); eval("1")\nos.system("ls " + x)\npassword = "abcdefgh"\nq = "SELECT " + x\n',
        "crlf.py": "eval(a)\r\nexec(b)\x0ceval(c) eval(d)\n", "bad.py": b"eval(x) \xff\xfe\n\xef\xbb\xbfDEBUG = True\n",
    }))
    return files.unionByName(files.limit(1).withColumn("path", F.lit("gone.py")).withColumn("content", F.lit(None).cast("binary")).withColumn("language", F.lit("python")))


@pytest.mark.parametrize("keep", ["first", "max_severity"])
def test_one_pass_equals_detection_and_shuffle(spark, make_files, keep):
    files = troubled(make_files)
    rules = spark.createDataFrame(rule_rows(20), RULE)
    patterns = PT.builtin_patterns() + PT.rule_patterns(rules)
    fused = SCAN.findings_of(files, patterns, keep=keep)
    apart = FD.dedup(SCAN.detect(files, patterns), keep)
    names = apart.columns
    rows = sorted(map(str, fused.select(*names).collect()))
    assert rows == sorted(map(str, apart.collect())) and len(rows) > 50
    problems = {(r.path, r.reason) for r in SCAN.fact_problems(files).collect()}
    assert problems == {("deep.py", "syntax_aborted"), ("gone.py", "unreadable")}


def test_counts_equal_separate_passes(spark, make_files):
    files = troubled(make_files)
    patterns = SCAN.compile_rules()
    counted = FP.counts_of(FP.analyze(files, patterns)).first()
    found = SCAN.findings_of(files, patterns)
    assert counted.files_analyzed == files.count()
    assert counted.total_lines_scanned == L.line_counts(files, "path").agg(F.sum("n_newlines")).first()[0]
    assert counted.rules_triggered == found.select("rule_id").distinct().count()
    clean = FP.counts_of(FP.analyze(files.where("path = 'empty.py'"), patterns)).first()
    assert (clean.files_analyzed, clean.total_lines_scanned, clean.rules_triggered) == (1, 0, 0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def content_scans(plan):
    return [s for s in plan.split("\n") if "ReadSchema" in s and "content:binary" in s]


def test_one_scan_and_no_exchange(spark, make_files, tmp_path):
    path = str(tmp_path / "files")
    make_files({"a.py": "eval(x)\n", "src/b.js": "y\n"}).write.parquet(path)
    files = spark.read.parquet(path)
    result = SCAN.scan(files)
    plan = plan_of(result.findings)
    assert len(content_scans(plan)) == 1 and "Exchange hashpartitioning" not in plan
    for name in ("stats", "summary", "problems"):
        assert len(content_scans(plan_of(getattr(result, name)))) == 1, name


def under_exchanges(plan):
    """Lines of the plan that lie below an exchange by hash."""
    below, depth = [], None
    for line in plan.split("\n"):
        at = len(line) - len(line.lstrip(" :+-*|"))
        if depth is not None and at <= depth:
            depth = None
        if depth is not None:
            below.append(line)
        elif "Exchange hashpartitioning" in line:
            depth = at
    return below


def test_lookups_do_not_move_text(spark, make_files, tmp_path, monkeypatch):
    path = str(tmp_path / "files")
    make_files({f"m{i}.py": "\n".join(f"line {i} {k}" for k in range(1, 9)) for i in range(20)}).write.parquet(path)
    files = spark.read.parquet(path)
    rows = [("p", f"m{i}.py", n, i) for i in range(0, 25, 3) for n in (1, 8, 9, 1)] + [("q", "m1.py", 1, 0), (None, "m1.py", 1, 0)]
    wanted = spark.createDataFrame(rows, "project_id string, path string, line_number int, extra int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, shown = L.lookup_lines(files, wanted), L.context_snippets(files, wanted, 1)
        for df in (found, shown):
            assert content_scans(plan_of(df)) and not any("content" in x for x in under_exchanges(plan_of(df)))
        first = [sorted(map(str, df.collect())) for df in (found, shown)]
        monkeypatch.setattr(L, "WANTED_ROWS", 0)
        again = [L.lookup_lines(files, wanted), L.context_snippets(files, wanted, 1)]
        assert any("content" in x for x in under_exchanges(plan_of(again[0])))
        assert [sorted(map(str, df.collect())) for df in again] == first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = sorted((p, f, n, e, f"line {f[1:-3]} {n}" if p == "p" and int(f[1:-3]) < 20 and n < 9 else "") for p, f, n, e in rows if p)
    assert sorted(tuple(r)[:5] for r in found.where("project_id is not null").collect()) == expected
    assert len(first[0]) == len(rows)


def test_long_top_lists_are_ranked_in_parts(spark):
    rows = [("p", f"f{i % 97}.py", i, "R", "LOW" if i % 5 else "HIGH") for i in range(4000)]
    findings = spark.createDataFrame(rows, "project_id string, file_path string, line_number int, rule_id string, severity string")
    for top, key in ((FD.top_per_severity, "severity"), (FD.top_per_project, "project_id")):
        found = top(findings, 1500)
        assert "_salt" in plan_of(found) and "_salt" not in found.columns
        rank = {"CRITICAL": 0, "HIGH": 1, "LOW": 3}
        want = []
        for k in sorted({r[4] if key == "severity" else r[0] for r in rows}):
            mine = [r for r in rows if k in (r[4], r[0])]
            order = sorted(mine, key=(lambda r: r[:4]) if key == "severity" else (lambda r: (rank[r[4]], *r[1:4])))
            want += [(k, n, *r[1:3]) for n, r in enumerate(order[:1500], 1)]
        assert sorted(tuple(r) for r in found.select(key, "rank", "file_path", "line_number").collect()) == sorted(want)
