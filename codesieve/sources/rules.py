"""Rule sources and sinks: the shipped pack, JSON and YAML files, directories."""

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import packs, vocab
from codesieve.functions.arrays import computed
from codesieve.schemas import INT, LOADED_RULE, RAW_RULE, RULE, TEXT, TEXTS, extend

try:
    import yaml
except ImportError:
    yaml = None


def shipped_rules(spark: SparkSession) -> DataFrame:
    """The packaged rules in load order. The table has a fixed handful of rows."""
    rows = []
    for load_ord, rule in enumerate(packs.SHIPPED_RULES):
        filled = {**packs.RULE_DEFAULTS, **rule}
        filled["metadata"] = {
            "cwe_id": rule["cwe_id"],
            "owasp_category": rule["owasp_category"],
            "references": rule["references"],
            "tags": rule["tags"],
            "author": None,
            "created_date": packs.SHIPPED_DATE,
            "last_updated": packs.SHIPPED_DATE,
        }
        rows.append([filled[f.name] for f in RULE.fields] + [load_ord])
    return F.broadcast(spark.createDataFrame(rows, LOADED_RULE))


def read_json_rules(spark: SparkSession, path: str) -> DataFrame:
    """Raw rule rows of a JSON file or glob; a file holds one rule or a list of rules."""
    raw = (
        spark.read.schema(RAW_RULE)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .json(path)
    )
    return raw.select("*", F.col("_metadata.file_name").alias("source"), F.lit(0).alias("kind"))


def read_yaml_rules(spark: SparkSession, path: str) -> DataFrame:
    """Raw rule rows of a YAML file or glob. Needs PyYAML on the workers."""
    if yaml is None:
        raise ImportError("reading YAML rules needs PyYAML")

    @F.arrow_udf(TEXTS)
    def documents(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            try:
                data = yaml.safe_load(text)
                items = data if isinstance(data, list) else [data]
                out.append([json.dumps(x, default=str) for x in items])
            except yaml.YAMLError as error:
                out.append([str(error)])
        return pa.array(out, pa.list_(pa.string()))

    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("source"), documents("value").alias("d"))
        .select("source", F.explode(computed("d")).alias("text"))
        .select(
            F.from_json(
                "text", RAW_RULE, {"columnNameOfCorruptRecord": "_corrupt_record"}
            ).alias("r"),
            "source",
        )
        .select("r.*", "source", F.lit(1).alias("kind"))
    )


def read_rule_directory(spark: SparkSession, directory: str) -> DataFrame:
    """Raw rules of all *.json files of a directory, then of its *.yaml and *.yml files."""
    raw = _optional(lambda: read_json_rules(spark, f"{directory}/*.json"))
    for kind, ending in enumerate(("yaml", "yml"), 1):
        more = _optional(lambda: read_yaml_rules(spark, f"{directory}/*.{ending}"))
        more = more if more is None else more.withColumn("kind", F.lit(kind))
        raw = more if raw is None else raw if more is None else raw.unionByName(more)
    if raw is None:
        return spark.createDataFrame([], extend(RAW_RULE, source=TEXT, kind=INT))
    return raw


def _optional(read):
    """A missing file kind is not an error of a directory."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except (AnalysisException, ImportError) as error:
        if isinstance(error, ImportError) or "PATH_NOT_FOUND" in str(error):
            return None
        raise


def accept_rules(raw: DataFrame, first_ord: int = 0) -> tuple[DataFrame, DataFrame]:
    """Usable rules in load order, and the rejected rows with a reason.

    Enumerations are normalised first; missing optional fields get their defaults.
    """
    normal = (
        raw.withColumn("severity", F.upper("severity"))
        .withColumn("category", F.lower("category"))
        .withColumn("rule_type", F.lower("rule_type"))
    )
    none = F.array().cast("array<string>")
    for name in ("patterns", "target_languages", "file_patterns", "excluded_paths"):
        normal = normal.withColumn(name, F.coalesce(name, none))
    for name, value in packs.RULE_DEFAULTS.items():
        normal = normal.withColumn(name, F.coalesce(name, F.lit(value)))
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), "unreadable")
        .when(F.coalesce("id", F.lit("")) == "", "missing id")
        .when(F.col("name").isNull(), "missing name")
        .when(F.col("description").isNull(), "missing description")
        .when(F.size("patterns") == 0, "no patterns")
        .when(~_one_of("severity", vocab.SEVERITIES), "bad severity")
        .when(~_one_of("category", vocab.CATEGORIES), "bad category")
        .when(~_one_of("rule_type", vocab.RULE_TYPES), "bad rule_type")
    )
    checked = normal.withColumn("reason", reason)
    in_file = F.monotonically_increasing_id()
    rules = (
        checked.withColumn("in_file", in_file)
        .where(F.col("reason").isNull())
        .orderBy("kind", "source", "in_file")
        .withColumn("load_ord", F.monotonically_increasing_id() + first_ord)
        .select(*RULE.names, "load_ord")
    )
    rejects = checked.where(F.col("reason").isNotNull()).select(
        "source", "id", "reason", "_corrupt_record"
    )
    return rules, rejects


def _one_of(column: str, values) -> F.Column:
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def write_rules(rules: DataFrame, path: str) -> None:
    """JSON lines with every field of the rule record (each line is also valid YAML)."""
    rules.select(*RULE.names).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json_rules_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw rule rows of a JSON-lines folder, as `write_rules` makes it."""
    raw = spark.read.schema(RAW_RULE).option("mode", "PERMISSIVE").json(path)
    return raw.select("*", F.col("_metadata.file_name").alias("source"), F.lit(0).alias("kind"))
