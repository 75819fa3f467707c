"""Constant tables as expressions. Each is one parsed expression, not one call per entry."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(value) -> str:
    """A value as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    text = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{text}'"


def array_sql(values: list) -> str:
    return "array(" + ", ".join(quote(v) for v in values) + ")"


def literal_array(values: list) -> Column:
    return F.expr(array_sql(values))


def literal_map(values: dict) -> Column:
    pairs = ", ".join(f"{quote(k)}, {quote(v)}" for k, v in values.items())
    return F.expr(f"map({pairs})")


def literal_map_of_arrays(values: dict) -> Column:
    pairs = ", ".join(f"{quote(k)}, {array_sql(v)}" for k, v in values.items())
    return F.expr(f"map({pairs})")
