"""Exact findings of small sources, derived by hand from the published behaviour."""

import re

import pytest

EVAL, SECRET = "DANGEROUS_FUNCTION_EVAL", "HARDCODED_SECRET_001"


def test_eval_is_high(scan_source):
    assert scan_source("eval(user_input)") == [(1, EVAL, "HIGH", None)]


def test_concatenated_query(scan_source):
    source = 'cursor.execute("SELECT * FROM users WHERE id = " + user_id)'
    assert scan_source(source) == [
        (1, "SQL_INJECTION_001", "HIGH", None),
        (1, "SQL_INJECTION_REGEX", "HIGH", 8),
    ]


def test_pack_rule_comes_before_the_syntax_rule_of_the_same_id(scan_source):
    source = 'cursor.execute("SELECT * FROM users WHERE id = " + user_id)'
    found = scan_source(source, pack=True, columns=("rule_id", "column", "confidence"))
    assert found == [("SQL_INJECTION_001", 1, 0.7), ("SQL_INJECTION_REGEX", 8, None)]


def test_keep_max_severity(scan_source):
    source = 'x = input("q")\ncursor.execute("SELECT " + x)'
    assert (2, "SQL_INJECTION_001", "HIGH", 1) in scan_source(source, pack=True)
    assert (2, "SQL_INJECTION_001", "CRITICAL", None) in scan_source(
        source, pack=True, keep="max_severity"
    )


def test_system_call_with_pack(scan_source):
    assert scan_source('os.system("rm -rf " + file_path)', pack=True) == [
        (1, "COMMAND_INJECTION_001", "MEDIUM", None),
        (1, "COMMAND_INJECTION_REGEX", "CRITICAL", 1),
        (1, "INJECTION_CMD_001", "CRITICAL", 1),
    ]


def test_taint_raises_severity(scan_source):
    assert (3, EVAL, "CRITICAL", None) in scan_source('\nuser_input = input("Enter: ")\neval(user_input)')


def test_taint_depends_on_order(scan_source):
    assert scan_source('eval(x)\nx = input("q")') == [(1, EVAL, "HIGH", None)]


def test_taint_chain(scan_source):
    source = 'x = input("q")\ny = x + "a"\nz = "b" + y\neval(z)'
    assert scan_source(source) == [(4, EVAL, "CRITICAL", None)]


def test_taint_is_one_level_deep_in_an_expression(scan_source):
    # x + "a" + "b" is (x + "a") + "b": neither side is a plain name.
    assert scan_source('x = input("q")\ny = x + "a" + "b"\neval(y)') == [(3, EVAL, "HIGH", None)]


def test_first_binary_operation_decides(scan_source):
    source = 'x = input("q")\neval(a + b, x)\neval(x, a + b)'
    assert scan_source(source) == [(2, EVAL, "HIGH", None), (3, EVAL, "CRITICAL", None)]


def test_call_on_a_source_taints_by_the_line(scan_source):
    assert (2, EVAL, "CRITICAL", None) in scan_source('x = input("a").strip()\neval(x)')


def test_dotted_accessor_is_no_source(scan_source):
    assert scan_source('x = request.args.get("q")\neval(x)') == [(2, EVAL, "HIGH", None)]
    assert scan_source("x = request.args(1)\neval(x)") == [(2, EVAL, "CRITICAL", None)]


def test_secrets(scan_source):
    assert scan_source('password = "secret123"\napi_key = "abc123def456"') == [
        (1, "HARDCODED_SECRETS_REGEX", "MEDIUM", 1),
        (1, SECRET, "HIGH", None),
        (2, "HARDCODED_SECRETS_REGEX", "MEDIUM", 1),
        (2, SECRET, "HIGH", None),
    ]


def test_attribute_target_is_no_syntax_secret(scan_source):
    assert scan_source('self.password = "abc123"') == [(1, "HARDCODED_SECRETS_REGEX", "MEDIUM", 6)]


def test_secret_message_names_the_first_target(scan_source):
    found = scan_source('token = login = "abcd"', columns=("rule_id", "message"))
    assert found == [(SECRET, "Possível hardcoded secret na variável 'token'")]


def test_secret_inside_a_string(scan_source):
    source = "s = \"api_key: 'abcdefghij0123456789' password: 'secret99'\""
    assert scan_source(source) == [(1, "HARDCODED_API_KEY_001", "MEDIUM", None)]


def test_syntax_error(scan_source):
    found = scan_source("def invalid_syntax(", columns=("line_number", "rule_id", "severity", "message", "code_snippet"))
    assert found == [
        (1, "SYNTAX_ERROR", "LOW", "Erro de sintaxe impede análise AST: '(' was never closed", None)
    ]


def test_null_byte_is_a_syntax_error(scan_source):
    assert [r[1] for r in scan_source("x = 1\0\n")] == ["SYNTAX_ERROR"]


@pytest.mark.parametrize(
    "source",
    [
        'cursor.execute("SELECT * FROM users WHERE id = ?", (user_id,))',
        "# eval(malicious_code) in documentation",
        "",
    ],
)
def test_clean(scan_source, source):
    assert scan_source(source) == []


def test_list_argument_call(scan_source):
    assert scan_source('subprocess.run(["ls", "-la"], shell=False)') == [
        (1, "COMMAND_INJECTION_001", "MEDIUM", None)
    ]


def test_column_counts_code_points(scan_source):
    source = '"\U0001f600é"; password = "abcdef1"'
    place = source.index("password") + 1
    assert (1, "HARDCODED_SECRETS_REGEX", "MEDIUM", place) in scan_source(source)


def test_form_feed_shifts_pattern_lines_only(scan_source):
    # The form feed ends a line for the patterns, not for the parser.
    found = scan_source('a = 1\x0c\npassword = "abcdef1"')
    assert (3, "HARDCODED_SECRETS_REGEX", "MEDIUM", 1) in found
    assert (2, SECRET, "HIGH", None) in found


def test_bad_bytes_are_dropped(scan_source):
    assert (1, "HARDCODED_SECRETS_REGEX", "MEDIUM", 1) in scan_source(b'pass\xffword = "abcdef1"')


def test_names_of_calls():
    import ast

    from codesieve.functions.pyfacts import dotted_name

    def name(code):
        return dotted_name(ast.parse(code).body[0].value.func)

    assert name("f()") == "f"
    assert name("os.system()") == "os.system"
    assert name("a.b.c()") == "a.b.c"
    assert name("f(1).g()") == "unknown.g"
    assert name("f(1).g.h()") == "unknown.g.h"
    assert name("f(1)(2)") == "f"
    assert name("a[0]()") == "unknown"


def test_deep_source_is_followed_without_recursion(scan_source):
    source = 'x = input("q")\n' + "y = " + " + ".join(["a"] * 900) + "\neval(x)"
    assert scan_source(source) == [(3, EVAL, "CRITICAL", None)]


def test_vulnerable_project(spark, make_files):
    """Three modules, a requirements file and a readme: a low score and all rule families."""
    from codesieve.operators.findings import family_coverage, high_priority
    from codesieve.plans.scan import scan

    sources = {
        "app.py": "import os\npassword = 'admin123'\nuser = input('u')\n"
        "query = \"SELECT * FROM t WHERE n = '\" + user + \"'\"\n"
        "cursor.execute(\"SELECT * FROM t WHERE n = '\" + user)\neval(user)\n",
        "pkg/run.py": "import os\ncmd = input('c')\nos.system('ls ' + cmd)\nexec(cmd)\n",
        "pkg/ok.py": "def add(a, b):\n    return a + b\n",
        "requirements.txt": "flask\n",
        "README.md": "# demo\n",
    }
    result = scan(make_files(sources, "demo"))
    assert result.findings.count() >= 5
    assert high_priority(result.findings).count() >= 3
    assert all(r.detected for r in family_coverage(result.findings).collect())
    (row,) = result.summary.collect()
    assert row.gate_code == 2 and row.score_class == "critical"
    (stats,) = result.stats.collect()
    assert (stats.files_analyzed, stats.files_skipped, stats.rules_applied) == (3, 0, 8)
    assert stats.total_lines_scanned == 12
    assert result.errors.count() == 0


def test_project_without_supported_files_has_no_score(make_files):
    from codesieve.plans.scan import scan

    result = scan(make_files({"Main.java": "class Main {}", "pom.xml": "<a/>"}, "j"))
    assert [(r.project_id, r.reason) for r in result.errors.collect()] == [("j", "unsupported_language")]
    (row,) = result.summary.collect()
    assert row.security_score is None and row.score_class is None


def test_project_of_unknown_files_is_skipped(make_files):
    """A suffix that is included but has no language gives skipped files and no score."""
    from codesieve.plans.scan import scan

    result = scan(make_files({"tool.pyw": "eval(x)\n"}, "w"))
    assert result.findings.count() == 0
    assert [r.reason for r in result.errors.collect()] == ["unsupported_language"]
    (stats,) = result.stats.collect()
    assert (stats.files_analyzed, stats.files_skipped) == (0, 1)


def test_lines_agree_with_python(spark, make_files):
    from codesieve.operators.lines import explode_lines, line_counts

    text = "a\r\nb\rc\n\nd\x0be\x1cf\x85g h\n"
    unified = re.sub("\r\n?", "\n", text)
    for source in (text, "", "\n", "x", "x\n\n", "\x0c"):
        files = make_files({"a.py": source})
        expected = re.sub("\r\n?", "\n", source).splitlines()
        rows = explode_lines(files, "path").orderBy("line_number").collect()
        assert [r.line for r in rows] == expected
        (counts,) = line_counts(files, "path").collect()
        assert counts.n_split_lines == len(expected)
        assert counts.n_newlines == len(re.findall("[^\n]*\n|[^\n]+$", re.sub("\r\n?", "\n", source)))
    assert unified.count("\n") == 5
