"""Untrusted input inside a file: sources, propagation through '+', and use in calls.

A file's facts are one array in walking order, so variables are followed inside the row, in time
linear in its facts: nothing is shuffled and no file needs another one. Taint is
file-wide, depends on the order of statements and is never cleared.
"""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from codesieve import vocab
from codesieve.schemas import FOLLOWED


def with_taint(files: DataFrame) -> DataFrame:
    """Add to rows that have `facts`: `taint`, the array of (var, seq), and `flags`, which says
    for each fact whether its arguments decide for tainted: the first plain-name argument that is
    tainted, or whatever the first binary operation says; arguments after that do not count.
    """
    followed = files.withColumn("followed", follow("facts"))
    return followed.withColumns({"taint": F.col("followed.taint"), "flags": F.col("followed.flags")}).drop("followed")


def follow_with_table(facts: list[dict]) -> tuple[dict[str, int], list[bool]]:
    """Follow the facts in walking order with a table: variable -> place; and a flag per fact."""
    table: dict[str, int] = {}
    flags = []
    for f in facts:
        flag = False
        for a in f["args"] or []:
            flag = a["name"] in table or a["left"] in table or a["right"] in table
            if flag or a["kind"] == "binop":
                break
        flags.append(flag)
        if f["value"] in ("source", "add"):
            names = f["targets"]
            if f["value"] == "add" and f["left"] not in table and f["right"] not in table:
                names = []
        else:
            is_source = f["line_target"] is not None and f["name"] in vocab.TAINT_SOURCES
            names = [f["line_target"]] if is_source else []
        for name in names:
            table.setdefault(name, f["seq"])
    return table, flags


_ARROW_FOLLOWED = to_arrow_type(FOLLOWED)


@F.arrow_udf(FOLLOWED)
def follow(facts: pa.Array) -> pa.Array:
    out = []
    for value in facts:
        rows = value.as_py()
        if rows is not None:
            table, flags = follow_with_table(rows)
            taint = [{"var": v, "seq": s} for v, s in table.items()]
            out.append({"taint": taint, "flags": flags})
        else:
            out.append(None)
    return pa.array(out, _ARROW_FOLLOWED)
