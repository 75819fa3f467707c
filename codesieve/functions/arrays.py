"""Rows out of computed arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def computed(array: Column | str) -> Column:
    """The same array, in a form that `explode` takes as an expression.

    For a plain column the optimizer infers the filter `size(column) > 0` and pushes it below
    the projection that computes the column, so a UDF behind it would run twice.
    """
    return F.filter(array, lambda x: x.isNotNull())
