"""Settings of scanned projects: `config/project.json` of the tree, deep-merged over other layers.

A layer is a table of leaves (project_id, key, value): the dotted place of everything that is no object, and its JSON
text. Objects merge key by key, all else replaces: a leaf of a lower layer is gone where a higher one has a leaf at its
place, above it or below it. An empty object is a leaf too, but one that gives way to what stands below it.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions import text as X

PATH = "config/project.json"
MAX_LEVELS = 32
EMPTY = "{}"


def _is_object() -> F.Column:
    return F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))


def leaves(documents: DataFrame) -> DataFrame:
    """(project_id, key, value) of rows (project_id, v variant), level by level; deeper than MAX_LEVELS stays JSON text."""
    spark, found, open_ = documents.sparkSession, [], documents.select("project_id", F.lit("").alias("key"), "v").where(_is_object())
    leaf = lambda rows: rows.select("project_id", "key", F.to_json("v").alias("value"))
    for _ in range(MAX_LEVELS):
        level = spark.sql(
            "SELECT r.project_id, concat_ws('.', nullif(r.key, ''), e.key) AS key, e.value AS v FROM {rows} r, LATERAL variant_explode(r.v) e", rows=open_
        )
        is_object = _is_object() & (F.to_json("v") != EMPTY)
        found.append(leaf(level.where(~F.coalesce(is_object, F.lit(False)))))
        open_ = level.where(is_object)
        if open_.isEmpty():
            break
    else:
        found.append(leaf(open_))
    return reduce(DataFrame.unionByName, found)


def read_settings(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves, errors) of the settings files among `files`; a file that is no JSON object falls back to the other layers."""
    mine = files.where(F.col("path") == PATH).select("project_id", "path", F.try_parse_json(X.decode_text(F.col("content"))).alias("v"))
    usable = F.coalesce(_is_object(), F.lit(False))
    errors = mine.where(~usable).select("project_id", "path", F.lit("bad_settings").alias("reason"), F.concat("path", F.lit(": no JSON object")).alias("message"))
    return leaves(mine.where(usable)), errors


def layer_of(spark: SparkSession, projects: DataFrame, settings: str) -> DataFrame:
    """The same JSON object as a layer of every project."""
    one = leaves(spark.range(1).select(F.lit("").alias("project_id"), F.parse_json(F.lit(settings)).alias("v")))
    entries = F.array(*[F.struct(F.lit(r["key"]).alias("key"), F.lit(r["value"]).alias("value")) for r in one.collect()])  # a setting each
    return projects.select("project_id", F.explode(entries).alias("e")).select("project_id", "e.*")


def deep_merge(*layers: DataFrame) -> DataFrame:
    """(project_id, key, value) of layers from the lowest to the highest."""
    return reduce(_over, layers)


def _over(lower: DataFrame, higher: DataFrame) -> DataFrame:
    ranked = lower.withColumn("layer", F.lit(0)).unionByName(higher.withColumn("layer", F.lit(1)))
    # A project's settings are one small group: the leaves of a handful of files.
    gathered = ranked.groupBy("project_id").agg(F.collect_list(F.struct("key", "value", "layer")).alias("all"))
    below = lambda upper, lower: F.startswith(upper["key"], F.concat(lower["key"], F.lit(".")))

    def hidden(x):
        def wins(y):
            over = (y["key"] == x["key"]) | below(y, x) | (below(x, y) & (y["value"] != EMPTY))
            gives_way = (x["value"] == EMPTY) & below(y, x)
            return ((y["layer"] > x["layer"]) & over) | gives_way

        return F.exists("all", wins)

    kept = gathered.select("project_id", F.explode(F.filter("all", lambda x: ~hidden(x))).alias("s"))
    return kept.select("project_id", "s.key", "s.value")


def project_options(settings: DataFrame) -> DataFrame:
    """One row per project with the scan options that its merged settings name, for `options.layer_options`."""
    columns = [
        F.max(F.when(F.col("key") == key, F.col("value").try_cast("double"))).alias(name)
        for name, (_, _, _, _, key) in vocab.OPTION_BOUNDS.items()
    ]
    return settings.groupBy("project_id").agg(*columns)
