"""Tables that are broadcast only after their size is known."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(table: DataFrame, max_rows: int, max_bytes: int) -> DataFrame | None:
    """The table as a constant with a broadcast hint, or None if it is larger.

    Estimates of aggregated tables are as large as their input, so the rows themselves are measured: at most
    max_rows + 1 of them reach the driver. A constant table is also not computed again by later plans.
    """
    rows = table.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))
