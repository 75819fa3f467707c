"""Job options per project: layers, bounds and warnings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve import vocab

NAMES = list(vocab.OPTION_BOUNDS)


def layer_options(
    projects: DataFrame,
    project_options: DataFrame | None = None,
    user: dict | None = None,
    call: dict | None = None,
) -> DataFrame:
    """One row of options per project: default < user < project < call.

    project_options may leave out columns, rows and values.
    """
    user, call = user or {}, call or {}
    table = projects.select("project_id")
    own = []
    if project_options is not None:
        own = [c for c in NAMES if c in project_options.columns]
        table = table.join(
            project_options.select("project_id", *[F.col(c).alias(f"p_{c}") for c in own]),
            "project_id",
            "left",
        )
    columns = []
    for name, (_, _, default, _, _) in vocab.OPTION_BOUNDS.items():
        layers = [F.lit(call.get(name))]
        if name in own:
            layers.append(F.col(f"p_{name}"))
        layers += [F.lit(user.get(name)), F.lit(default)]
        columns.append(F.coalesce(*[x.cast("double") for x in layers]).alias(name))
    return table.select("project_id", *columns)


def clamp_options(options: DataFrame) -> DataFrame:
    """Values moved into their bounds, with a warning text for each that was outside."""
    warnings, columns = [], []
    for name, (low, high, _, unit, key) in vocab.OPTION_BOUNDS.items():
        value = F.col(name)
        warnings.append(
            F.when(value < low, vocab.MSG_OPTION_LOW % (key, low, unit)).when(
                value > high, vocab.MSG_OPTION_HIGH % (key, high, unit)
            )
        )
        columns.append(F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))).alias(name))
    return options.select(
        "project_id", *columns, F.array_compact(F.array(*warnings)).alias("warnings")
    )
