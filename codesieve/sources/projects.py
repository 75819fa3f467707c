"""Project manifests as JSON. Files and statistics of a manifest are recomputed, not loaded."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.schemas import PROJECT


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; unknown target languages are dropped, sets are sorted."""
    known = F.array(*[F.lit(x) for x in [*dict.fromkeys(vocab.EXTENSION_LANGUAGE.values()), "unknown"]])
    default = F.array(*[F.lit(x) for x in vocab.INCLUDED_EXTENSIONS])
    none = F.array().cast("array<string>")
    raw = spark.read.schema(PROJECT).option("multiLine", True).json(path)
    targets = F.array_intersect(F.transform("target_languages", F.lower), known)
    extensions = F.when(F.size("included_extensions") > 0, F.col("included_extensions"))
    return raw.select(
        F.col("root_path").alias("project_id"),
        "name",
        "root_path",
        "description",
        F.to_timestamp_ntz("created_at").alias("created_at"),
        F.to_timestamp_ntz("last_scanned").alias("last_scanned"),
        F.array_sort(F.coalesce(targets, none)).alias("target_languages"),
        F.coalesce("excluded_paths", none).alias("excluded_paths"),
        F.array_sort(F.coalesce(extensions, default)).alias("included_extensions"),
    )


def iso_text(moment: F.Column) -> F.Column:
    """ISO text of a timestamp; the fraction is left out when it is zero."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction))


def manifest_json(projects: DataFrame) -> DataFrame:
    """(project_id, json) with the manifest fields in their published order."""
    return projects.select(
        "project_id",
        F.to_json(
            F.struct(
                "name",
                "root_path",
                "description",
                iso_text(F.col("created_at")).alias("created_at"),
                iso_text(F.col("last_scanned")).alias("last_scanned"),
                "target_languages",
                "excluded_paths",
                "included_extensions",
            ),
            {"ignoreNullFields": "false"},
        ).alias("json"),
    )


def write_projects(projects: DataFrame, path: str) -> None:
    manifest_json(projects).select("json").write.mode("overwrite").text(path)
