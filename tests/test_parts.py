"""Functions, rule sources, sinks, options and plan shapes."""

import dataclasses
import json
import os
import random
import re
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codesieve import packs, vocab
from codesieve.functions import paths as P
from codesieve.functions import regex as R
from codesieve.functions import text as X


def new_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_languages_and_suffixes(spark):
    cases = {
        "app.py": ".py python", "script.js": ".js javascript", "component.tsx": ".tsx typescript",
        "Main.java": ".java java", "program.cpp": ".cpp cpp", "style.css": ".css stylesheet",
        "readme.txt": ".txt unknown", ".bashrc": " unknown", "a.tar.gz": ".gz unknown",
        "x.": " unknown", "d.py/B.PY": ".py python", "tool.pyw": ".pyw unknown",
    }
    df = spark.createDataFrame([(c,) for c in cases], "path string")
    got = df.select("path", P.extension(F.col("path")).alias("e"), P.language(F.col("path")).alias("l"))
    assert {r.path: f"{r.e} {r.l}" for r in got.collect()} == cases


@pytest.mark.parametrize(
    "glob, yes, no",
    [
        ("*.py", "a/b.py", "a/b.pyc"),
        ("test_*.py", "x/test_a.py", "x/atest_a.py"),
        ("src/*.js", "lib/src/a.js", "lib/asrc/a.js"),
        ("[!a]?.c", "bb.c", "ab.c"),
        ("*.tar.gz", "x.tar.gz", "xtar.gz"),
    ],
)
def test_globs(glob, yes, no):
    regex = P.glob_regex(glob).replace("\\z", "$")
    assert re.search(regex, yes) and not re.search(regex, no)


def test_strip_and_decode(spark):
    blanks = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    df = spark.createDataFrame([(blanks + "a b" + blanks,)], "s string")
    assert df.select(X.strip(F.col("s"))).first()[0] == "a b"
    raws = [b"a\xffb", b"\xe2\x82x", "é�".encode() + b"\xc3", b"a\r\nb\rc", "﻿x".encode()]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, b binary")
    got = {r.i: r.t for r in df.select("i", X.decode_text(F.col("b")).alias("t")).collect()}
    for i, raw in enumerate(raws):
        assert got[i] == re.sub("\r\n?", "\n", raw.decode("utf-8", "ignore"))


ALL_PATTERNS = [p for pack in (packs.BUILTIN_PATTERNS, packs.SHIPPED_RULES) for r in pack for p in r["patterns"]]


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_anchors_never_hide_a_match(data):
    """Texts made to match a pattern always contain one of its anchors."""
    pattern = data.draw(st.sampled_from(ALL_PATTERNS))
    text = data.draw(st.from_regex(re.compile(pattern, re.I), fullmatch=False))
    folded = text.translate(str.maketrans("ſKİı", "skii")).lower()
    assert not R.anchors(pattern) or any(a in folded for a in R.anchors(pattern))


def test_pattern_dialects(spark):
    assert R.pattern_error("(a") and R.pattern_error("[a-") and not R.pattern_error("a{2,}")
    assert R.to_java(r"(?P<n>[[&&]\s)\Z") == r"(?<n>[\[\&&][\s\x1c-\x1f])\z"
    assert R.to_java("[]a][^]b]") == r"[\]a][^\]b]"
    assert R.matches_empty("a*") and not R.matches_empty("a+")
    assert R.jvm_accepts(["a+", "(?(1)a|b)", "b"]) == [True, False, True]


def test_user_patterns_match_like_python(spark, make_files):
    """Patterns the JVM cannot run, empty matches and non-ASCII text give Python's spans."""
    from codesieve.operators.inventory import with_language
    from codesieve.operators.lines import explode_lines
    from codesieve.operators.patterns import all_matches, first_matches, rule_patterns

    texts = ["(a)?(?(1)b|c)", "x*", r"\w+é", r"(?P<q>['\"])z(?P=q)", "k", "(bad"]
    rows = [(i, f"r{i}", "LOW", "xss", "regex", [t], [], False, False, 0.5, "d") for i, t in enumerate(texts)]
    rules = spark.createDataFrame(
        rows,
        "load_ord bigint, id string, severity string, category string, rule_type string, "
        "patterns array<string>, target_languages array<string>, case_sensitive boolean, "
        "multiline boolean, confidence_threshold double, description string",
    )
    patterns = rule_patterns(rules)
    assert [p.rule_id for p in patterns if not p.on_jvm] == ["r0", "r1"]
    source = "ab c 'z' \U0001f600 Kaféxx été\nK k 'z\"\n"
    lines = explode_lines(with_language(make_files({"a.py": source})), "project_id", "path", "language")
    got = {
        (r.rule_id, r.line_number, r.start_column, r.end_column)
        for r in all_matches(lines, patterns).collect()
    }
    expected = {
        (f"r{i}", n, m.start(), m.end())
        for i, t in enumerate(texts[:-1])
        for n, line in enumerate(source.splitlines(), 1)
        for m in re.finditer(t, line, re.I)
    }
    assert got == expected
    firsts = {(r.rule_id, r.line_number, r.column) for r in first_matches(lines, patterns).collect()}
    assert firsts == {
        (rule, n, min(s for r, k, s, _ in expected if (r, k) == (rule, n)) + 1)
        for rule, n, _, _ in expected
    }


def test_more_patterns_than_a_block(spark, make_files, monkeypatch):
    from codesieve.operators import patterns as PT
    from codesieve.operators.inventory import with_language
    from codesieve.operators.lines import explode_lines

    files = with_language(make_files({"a.py": 'password = "abcdef1"\neval(x)\nDEBUG = True\n'}))
    lines = explode_lines(files, "project_id", "path", "language")
    every = PT.builtin_patterns() + PT.shipped_patterns()
    whole = sorted(PT.first_matches(lines, every).collect())
    monkeypatch.setattr(PT, "BLOCK", 7)
    from codesieve.operators.findings import dedup

    def kept(df):
        return sorted(map(str, dedup(PT.to_findings(df)).collect()))

    blocks = PT.first_matches(lines, every)
    in_blocks = kept(blocks)
    monkeypatch.setattr(PT, "BLOCK", 200)
    assert in_blocks == kept(PT.first_matches(lines, every)) and whole


def test_taint_equals_a_plain_walk(spark, make_files):
    from codesieve.operators.syntax import extract_facts
    from codesieve.operators.taint import with_taint

    rng = random.Random(7)
    names = [f"v{i}" for i in range(12)]
    pick = lambda: rng.choice(names)
    sources = {}
    for k in range(30):
        lines = []
        for _ in range(60):
            lines.append(
                rng.choice(
                    [
                        f"{pick()} = input('q')",
                        f"{pick()} = {pick()} + 'a'",
                        f"{pick()} = {pick()} = 'b' + {pick()}",
                        f"{pick()} = raw_input(1)[0]",
                        f"{pick()} = input('z').strip()",
                        f"eval({pick()}, {pick()} * 2, {pick()})",
                        f"os.system({pick()} + {pick()})",
                    ]
                )
            )
        sources[f"f{k}.py"] = "\n".join(lines)
    facts = extract_facts(make_files(sources))
    sources_of_taint = ("input", "raw_input")
    some_flag = False
    for row in with_taint(facts).collect():
        tainted, flags = [], []
        for f in row.facts:
            names = lambda a: [a.name] if a.kind == "name" else [a.left, a.right]
            args = list(f.args or [])
            ends = [i for i, a in enumerate(args) if a.kind == "binop"]
            deciding = args[: ends[0] + 1] if ends else args
            flags.append(any(n in dict(tainted) for a in deciding for n in names(a)))
            new = []
            if f.value == "source" or (f.value == "add" and {f.left, f.right} & set(dict(tainted))):
                new = f.targets
            elif f.value is None and f.line_target and f.name in sources_of_taint:
                new = [f.line_target]
            tainted += [(n, f.seq) for n in dict.fromkeys(new) if n not in dict(tainted)]
        assert sorted(map(tuple, row.taint)) == sorted(tainted)
        assert [bool(x) for x in row.flags] == flags
        some_flag |= any(flags)
    assert some_flag


def test_many_patterns_are_one_scan(spark, tmp_path):
    from codesieve.operators import patterns as PT
    from codesieve.operators.lines import explode_lines

    rows = [("p", f"a{i}.py", f"word{i} = 1\n".encode(), "python") for i in range(450)]
    spark.createDataFrame(rows, "project_id string, path string, content binary, language string").write.parquet(f"{tmp_path}/t")
    lines = explode_lines(spark.read.parquet(f"{tmp_path}/t"), "project_id", "path", "language")
    model = PT.builtin_patterns()[0]
    many = [dataclasses.replace(model, rule_ord=i, rule_id=f"R{i}", text=f"word{i} ") for i in range(450)]
    found = PT.first_matches(lines, many)
    assert plan_of(found).count("FileScan parquet") == 1
    assert {r.rule_id for r in found.collect()} == {f"R{i}" for i in range(450)}


def test_dedup_keeps_the_first_and_is_idempotent(spark):
    from codesieve.operators.findings import dedup

    rows = [
        ("p", "test.py", 1, "DUPLICATE_RULE", "HIGH", "First", 0, 0, 0, 1),
        ("p", "test.py", 1, "DUPLICATE_RULE", "MEDIUM", "Zero", 0, 0, 0, 0),
        ("p", "test.py", 2, "UNIQUE_RULE", "LOW", "Unique", 0, 0, 0, 0),
    ]
    order = "phase int, rule_ord int, pattern_ord int, match_ord int"
    found = spark.createDataFrame(
        rows,
        "project_id string, file_path string, line_number int, rule_id string, severity string, "
        f"message string, {order}",
    )
    once = dedup(found)
    assert sorted(r.message for r in once.collect()) == ["Unique", "Zero"]
    assert sorted(r.message for r in dedup(found, "max_severity").collect()) == ["First", "Unique"]
    again = dedup(once.select("*", *[F.lit(0).alias(c.split()[0]) for c in order.split(", ")]))
    assert sorted(again.collect()) == sorted(once.select(*again.columns).collect())


def test_scores_classes_and_gates(spark):
    from codesieve.functions import scoring as S

    expected = {100.0: "clean", 95.0: "excellent", 90.0: "excellent", 80.0: "good", 60.0: "critical",
                50.0: "critical", 49.0: "poor", 25.0: "poor", 24.0: "critical", 0.0: "critical"}
    df = spark.createDataFrame([(s,) for s in expected], "s double")
    got = {r.s: r.c for r in df.select("s", S.score_class(F.col("s")).alias("c")).collect()}
    assert got == expected
    df = spark.createDataFrame([(1, 0, 2), (0, 6, 1), (0, 5, 0)], "c int, h int, g int")
    assert df.where(S.gate_code(F.col("c"), F.col("h")) != F.col("g")).count() == 0


def test_rule_sources(spark):
    from codesieve.operators.rules import combine, validation_report
    from codesieve.sources import rules as SR

    folder = new_dir()
    good = {"id": "A", "name": "a", "description": "d", "severity": "high", "category": "XSS",
            "rule_type": "REGEX", "patterns": ["x"], "metadata": {"cwe_id": "CWE-1"}}
    bad = [{**good, "id": ""}, {**good, "patterns": []}, {**good, "severity": "odd"},
           {k: v for k, v in good.items() if k != "name"}]
    with open(f"{folder}/a.json", "w") as f:
        json.dump([good, *bad], f)
    with open(f"{folder}/b.json", "w") as f:
        json.dump({**good, "id": "B", "category": "cryptography"}, f)
    with open(f"{folder}/broken.json", "w") as f:
        f.write("[{ nope")
    with open(f"{folder}/c.yaml", "w") as f:
        f.write("- id: A\n  name: second\n  description: d\n  severity: LOW\n  category: xss\n"
                "  rule_type: regex\n  patterns: ['y']\n  enabled: false\n")
    with open(f"{folder}/d.yml", "w") as f:
        f.write("id: C\nname: c\ndescription: d\nseverity: INFO\ncategory: xxe\nrule_type: ast\npatterns: [z]\n")
    with open(f"{folder}/e.yml", "w") as f:
        f.write("a: [unclosed")
    rules, rejects = SR.accept_rules(SR.read_rule_directory(spark, folder))
    rows = rules.orderBy("load_ord").collect()
    assert [(r.id, r.severity, r.category, r.enabled) for r in rows] == [
        ("A", "HIGH", "xss", True), ("B", "HIGH", "cryptography", True),
        ("A", "LOW", "xss", False), ("C", "INFO", "xxe", True),
    ]
    assert rows[0].case_sensitive is True and rows[0].confidence_threshold == 0.5
    assert sorted(r.reason for r in rejects.collect()) == [
        "bad severity", "missing id", "missing name", "no patterns", "unreadable", "unreadable",
    ]
    (report,) = validation_report(rules).collect()
    assert (report.total_rules, report.valid_rules, report.n_duplicates, report.n_warnings) == (4, 4, 1, 2)
    everything = combine(SR.shipped_rules(spark), rules)
    assert everything.count() == 8 + 3
    assert everything.where("id = 'A'").first().name == "second"
    out = new_dir() + "/rules"
    SR.write_rules(rules, out)
    back, none = SR.accept_rules(SR.read_json_rules_lines(spark, out))
    assert back.count() == 4 and none.count() == 0
    assert SR.read_rule_directory(spark, new_dir()).count() == 0


def test_shipped_patterns_equal_the_rule_table(spark):
    from codesieve.operators.patterns import rule_patterns, shipped_patterns
    from codesieve.sources.rules import shipped_rules

    assert rule_patterns(shipped_rules(spark)) == shipped_patterns()


def test_files_from_storage(spark):
    import os

    from codesieve.sources.files import read_files

    root = new_dir()
    for path in ("one/app.py", "one/src/deep/x y.py", "two/b.js"):
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "w") as f:
            f.write("eval(x)\n" * 3)
    rows = {(r.project_id, r.path, r.size_bytes) for r in read_files(spark, root, 1).collect()}
    assert rows == {("one", "app.py", 24), ("one", "src/deep/x y.py", 24), ("two", "b.js", 24)}
    assert {r.path for r in read_files(spark, f"{root}/one").collect()} == {"app.py", "src/deep/x y.py"}
    small = read_files(spark, root, 1, max_bytes=10)
    assert small.count() == 0
    assert "LessThanOrEqual(length,10)], ReadSchema" in plan_of(small)


def test_incremental_scan_equals_batch(spark):
    import os

    from codesieve.operators.findings import dedup
    from codesieve.operators.inventory import with_language
    from codesieve.operators.scoring import report_summary
    from codesieve.plans.scan import compile_rules, detect
    from codesieve.sources.files import read_files
    from codesieve.streaming import incremental as INC

    root, out = new_dir(), INC.new_output(spark)
    patterns = compile_rules()

    def add(name, text):
        os.makedirs(f"{root}/p/{name[0]}", exist_ok=True)
        with open(f"{root}/p/{name[0]}/{name}", "w") as f:
            f.write(text)

    def run():
        INC.scan_increment(INC.stream_files(spark, root, 1, max_files=1), patterns, out)

    add("a.py", 'x = input("q")\neval(x)\n')
    add("b.py", 'password = "abcdef1"\n')
    run()
    add("c.py", "os.system('ls ' + x)\n")
    run()
    batch = dedup(detect(with_language(read_files(spark, root, 1)), patterns))
    stream = INC.increment_findings(spark, out).select(*batch.columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    totals = INC.increment_summary(spark, out)
    expected = report_summary(batch)
    assert totals.collect() == expected.select(*totals.columns).collect()


def test_reports(spark, make_files):
    from codesieve.plans.scan import scan
    from codesieve.sources import reports as RP

    files = make_files({"a.py": 'eval(input("q"))\npassword = "a\\"b,cdef"\n'}, "p")
    files = files.unionByName(make_files({"ok.py": "x = 1\n"}, "clean"))
    result = scan(files)
    projects = files.select("project_id").distinct()
    reports = RP.report_json(result.findings, projects, "2024-01-01 10:00:00", 1.5)
    documents = {r.project_id: json.loads(r.json) for r in reports.collect()}
    assert list(documents["p"]) == [
        "target_path", "scan_started_at", "scan_duration", "analyzer_version", "summary", "findings",
    ]
    assert documents["p"]["scan_started_at"] == "2024-01-01T10:00:00"
    assert documents["clean"]["findings"] == [] and documents["clean"]["summary"]["security_score"] == 100.0
    assert list(documents["p"]["findings"][0]) == [
        "file_path", "line_number", "column", "rule_id", "severity", "message", "category", "cwe_id",
        "confidence", "code_snippet", "found_at",
    ]
    out = new_dir()
    RP.write_reports(result.findings, projects, f"{out}/json")
    loaded = RP.read_reports(spark, f"{out}/json")
    again = RP.recompute_summary(loaded).orderBy("project_id")
    first = result.summary.select(*again.columns).orderBy("project_id")
    assert again.collect() == first.collect()
    RP.write_csv(result.findings, f"{out}/csv")
    table = spark.read.option("header", True).option("escape", '"').csv(f"{out}/csv")
    assert table.columns == vocab.CSV_HEADER and table.count() == result.findings.count()
    RP.write_finding_rows(result.findings, f"{out}/rows")
    assert spark.read.json(f"{out}/rows").count() == result.findings.count()


def test_manifests(spark):
    from codesieve.sources.projects import read_projects, write_projects

    folder = new_dir()
    with open(f"{folder}/m.json", "w") as f:
        json.dump({"name": "n", "root_path": "/srv/n", "created_at": "2024-05-01T10:00:00.250000",
                   "target_languages": ["python", "klingon"], "excluded_paths": ["x"], "stats": {"total_files": 9},
                   "files": [{"path": "a.py"}]}, f, indent=1)
    (row,) = read_projects(spark, f"{folder}/m.json").collect()
    assert row.target_languages == ["python"] and row.included_extensions == [".py", ".pyw"]
    write_projects(read_projects(spark, f"{folder}/m.json"), f"{folder}/out")
    (back,) = read_projects(spark, f"{folder}/out/*.txt").collect()
    assert back == row


def test_options(spark):
    from codesieve.operators.options import clamp_options, layer_options

    projects = spark.createDataFrame([("a",), ("b",)], "project_id string")
    own = spark.createDataFrame([("a", 500.0)], "project_id string, max_file_size_mb double")
    rows = {r.project_id: r for r in clamp_options(
        layer_options(projects, own, user={"max_depth": 3}, call={"max_depth": 0})).collect()}
    assert rows["a"].max_file_size_mb == 100.0 and rows["b"].max_file_size_mb == 10.0
    assert rows["b"].max_depth == 1.0
    assert rows["a"].warnings == [
        "analysis.max_file_size_mb ultrapassou o limite, limitado a 100.0 MB",
        "analysis.max_depth muito abaixo do mínimo permitido, ajustado para 1 níveis",
    ]


def test_plan_shapes(spark, make_files, tmp_path):
    """No shuffle before findings exist, no join of lines with patterns, early rank limits."""
    from codesieve.operators.detectors import line_pattern_findings, python_syntax_findings
    from codesieve.operators.findings import dedup, top_per_project
    from codesieve.operators.inventory import with_language
    from codesieve.plans.scan import compile_rules

    path = str(tmp_path / "files")
    make_files({"a.py": "eval(x)\n"}).write.parquet(path)
    files = with_language(spark.read.parquet(path))
    for detect in (line_pattern_findings, python_syntax_findings):
        plan = plan_of(detect(files, compile_rules()))
        assert "Exchange" not in plan and "Join" not in plan
        assert "ReadSchema: struct<project_id:string,path:string,content:binary>" in plan
    from codesieve.operators import syntax as SY

    facts = SY.extract_facts(files)
    for df, n in ((SY.facts_table(facts), 1), (SY.taint_table(facts), 2), (SY.all_syntax_findings(facts), 2)):
        assert 1 <= plan_of(df).count("ArrowEvalPython") <= n
    found = line_pattern_findings(files, compile_rules())
    top = plan_of(top_per_project(dedup(found), 3))
    assert "WindowGroupLimit" in top


def test_one_huge_line_stays_linear(spark, make_files):
    """A file of one line with many hits: its text is copied once per rule, not once per hit."""
    from codesieve.operators.findings import dedup
    from codesieve.operators.inventory import with_language
    from codesieve.operators.patterns import builtin_patterns
    from codesieve.plans.scan import detect

    text = "; ".join(f"eval(a{i})" for i in range(20_000))
    found = dedup(detect(with_language(make_files({"a.py": text})), builtin_patterns())).collect()
    assert [(r.rule_id, len(r.code_snippet)) for r in found] == [("DANGEROUS_FUNCTION_EVAL", len(text))]


def test_written_findings_are_read_back(spark, make_files):
    from codesieve.plans.scan import scan

    files = make_files({f"m{i}.py": "eval(x)\n" for i in range(3)})
    fresh, written = scan(files), scan(files).write(new_dir() + "/findings")
    assert "FileScan parquet" in plan_of(written.findings)
    assert fresh.summary.collect() == written.summary.collect()
    assert fresh.stats.collect() == written.stats.collect()


def test_profiles_are_broadcast_only_when_small(spark, make_files, monkeypatch):
    from codesieve.plans import scan as SCAN

    files = make_files({"a.py": "eval(x)\n", "src/b.py": "y = 1\n"})
    few = SCAN.discover(files)
    monkeypatch.setattr(SCAN, "BROADCAST_BYTES", 0)
    many = SCAN.discover(files)
    assert "ResolvedHint (strategy=broadcast)" in few._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_result_does_not_depend_on_partitions(spark, make_files):
    from codesieve.plans.scan import scan

    files = make_files({f"m{i}.py": f'x = input("q")\neval(x)\npassword = "abc{i}def"\n' for i in range(20)})
    one = scan(files.repartition(1)).findings
    many = scan(files.repartition(13)).findings
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_directory_scan_opens_only_wanted_files(spark):
    from codesieve.plans.scan import scan, scan_directory
    from codesieve.sources.files import read_files

    root = new_dir()
    for path, text in {"p/a.py": "eval(x)\n", "p/B.PY": "exec(y)\n", "p/pic.png": "x" * 100, "q/big.py": "#" * 200_000, "q/lib.js": "eval(z)"}.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "w") as f:
            f.write(text)
    options = spark.createDataFrame([("q", 0.1, 10.0)], "project_id string, max_file_size_mb double, max_depth double")
    for name in ("max_workers", "timeout_seconds", "min_confidence"):
        options = options.withColumn(name, F.lit(None).cast("double")) if name not in options.columns else options
    from codesieve.operators.options import layer_options

    options = layer_options(options.select("project_id"), options)
    pruned = scan_directory(spark, root, 1, options=options)
    plain = scan(read_files(spark, root, 1), options=options)
    for name in ("findings", "errors", "summary", "accounting"):
        rows = [sorted(map(str, getattr(s, name).drop("last_modified").collect())) for s in (pruned, plain)]
        assert rows[0] == rows[1], name
    assert {(r.path, r.reason) for r in pruned.errors.collect()} == {("big.py", "file_too_large")}
