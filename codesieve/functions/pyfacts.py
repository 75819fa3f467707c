"""Syntax facts of Python source: the one place where a parser is needed.

`py_facts` turns the text of a file into an array of facts in visiting order. It only
reports what is written (who is called with what, what is assigned to what); deciding
what a fact means is left to DataFrame expressions. Facts nobody asks about are not
emitted, so an array is small next to its file.
"""

import ast
import re
import warnings

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from codesieve import vocab
from codesieve.schemas import FACTS

_CALLS = {*vocab.DANGEROUS_FUNCTIONS, *vocab.SYSTEM_CALLS, *vocab.TAINT_SOURCES}
_SECRET_HINT = re.compile("(?i)key|password|secret|token")
_INPUT_LINE = re.compile(vocab.INPUT_LINE)


def dotted_name(node: ast.AST) -> str:
    """Name of a called thing: a, a.b, a.b.c, unknown.attr; calls are looked through."""
    parts = []
    while True:
        if isinstance(node, ast.Attribute):
            parts.append(node.attr)
            if not isinstance(node.value, (ast.Name, ast.Attribute)):
                base = "unknown"
                break
            node = node.value
        elif isinstance(node, ast.Call) and not parts:
            node = node.func
        else:
            base = node.id if isinstance(node, ast.Name) else "unknown"
            break
    return ".".join([base, *reversed(parts)])


def _name(node: ast.AST) -> str | None:
    return node.id if isinstance(node, ast.Name) else None


def _operands(node: ast.BinOp) -> dict:
    return {"left": _name(node.left), "right": _name(node.right)}


def _argument(node: ast.AST) -> dict | None:
    if isinstance(node, ast.Name):
        return {"kind": "name", "name": node.id}
    if isinstance(node, ast.BinOp):
        plain = isinstance(node.left, (ast.Constant, ast.Name)) or isinstance(
            node.right, (ast.Constant, ast.Name)
        )
        is_add = isinstance(node.op, ast.Add)
        return {"kind": "binop", "is_add": is_add, "plain_side": plain, **_operands(node)}
    return None


def _call(node: ast.Call, about_line) -> dict | None:
    name = dotted_name(node.func)
    if name not in _CALLS and not any(part in name for part in vocab.SQL_NAME_PARTS):
        return None
    concat, target = about_line(node.lineno)
    kw_add = any(
        isinstance(k.value, ast.BinOp) and isinstance(k.value.op, ast.Add) for k in node.keywords
    )
    args = [a for a in map(_argument, node.args) if a]
    return {
        "kind": "call", "name": name, "args": args, "kw_add": kw_add,
        "line_concat": concat, "line_target": target,
    }


def _assign(node: ast.Assign) -> dict | None:
    targets = [t.id for t in node.targets if isinstance(t, ast.Name)]
    value = node.value
    fact = {"kind": "assign", "targets": targets}
    if not targets:
        return None
    if isinstance(value, ast.Call) and dotted_name(value.func) in vocab.TAINT_SOURCES:
        return {**fact, "value": "source"}
    if isinstance(value, ast.BinOp) and isinstance(value.op, ast.Add) and any(_operands(value).values()):
        return {**fact, "value": "add", **_operands(value)}
    if isinstance(value, ast.Constant) and isinstance(value.value, str) and len(value.value) > 3:
        return {**fact, "value": "str"}
    return None


def _string(node: ast.Constant) -> dict | None:
    if isinstance(node.value, str) and _SECRET_HINT.search(node.value):
        text = node.value.encode("utf-8", "replace").decode()
        return {"kind": "str", "text": text}
    return None


def facts_of(source: str) -> list[dict]:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(source)
    except SyntaxError as error:
        return [{"kind": "syntax_error", "seq": 0, "lineno": error.lineno, "text": error.msg}]
    except (RecursionError, MemoryError) as error:
        return [{"kind": "aborted", "seq": 0, "text": type(error).__name__}]

    lines = source.splitlines()
    seen: dict[int, tuple] = {}

    def about_line(number: int) -> tuple:
        if number not in seen:
            line = lines[number - 1].strip() if 1 <= number <= len(lines) else ""
            upper = line.upper() if "+" in line else ""
            match = _INPUT_LINE.match(line)
            seen[number] = (any(v in upper for v in vocab.SQL_VERBS), match and match.group(1))
        return seen[number]

    facts, stack, seq = [], [tree], 0
    while stack:
        node = stack.pop()
        if isinstance(node, ast.Call):
            fact = _call(node, about_line)
        elif isinstance(node, ast.Assign):
            fact = _assign(node)
        elif isinstance(node, ast.Constant):
            fact = _string(node)
        else:
            fact = None
        if fact:
            facts.append({**fact, "seq": seq, "lineno": node.lineno})
        seq += 1
        stack.extend(reversed(list(ast.iter_child_nodes(node))))
    return facts


def safe_facts(source: str | None) -> list[dict] | None:
    if not source:
        return []
    try:
        return facts_of(source)
    except Exception as error:  # one bad file must not end the job; it becomes a finding
        return [{"kind": "error", "seq": 0, "lineno": 1, "text": str(error)}]


_ARROW_FACTS = to_arrow_type(FACTS)


@F.arrow_udf(FACTS)
def py_facts(sources: pa.Array) -> pa.Array:
    return pa.array((safe_facts(s.as_py()) for s in sources), _ARROW_FACTS)
