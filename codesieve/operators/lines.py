"""Files to numbered lines, line counts, line lookup and context snippets.

Line operators stay inside the row of their file: no shuffle of source text.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.functions import text as X
from codesieve.functions.arrays import computed
from codesieve.functions.sizes import broadcast_if_small

# Wanted lines up to this size travel to the files; for more of them the files are shuffled.
WANTED_ROWS, WANTED_BYTES = 1_000_000, 64 * 1024 * 1024


def with_text(files: DataFrame) -> DataFrame:
    """Replace the raw bytes by decoded text."""
    return files.withColumn("text", X.decode_text(F.col("content"))).drop("content")


def explode_lines(files: DataFrame, *keep: str) -> DataFrame:
    """One row per line, numbered from 1. Only the named file columns are carried along."""
    return (
        with_text(files)
        .select(*keep, F.posexplode(X.split_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("line_number", F.col("pos") + 1)
        .drop("pos")
    )


def line_counts(files: DataFrame, *keep: str) -> DataFrame:
    """Both line notions per file, without exploding it."""
    text = F.col("text")
    return with_text(files).select(
        *keep,
        X.count_split_lines(text).alias("n_split_lines"),
        X.count_newlines(text).alias("n_newlines"),
    )


def lookup_lines(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Raw and stripped text of the wanted (project_id, path, line_number) rows; '' if missing.

    The wanted rows of a file travel to it as one small row, so that text stays where it is. Rows whose
    file does not exist are found by paths alone.
    """
    keys, own = ["project_id", "path"], [c for c in wanted.columns if c not in ("project_id", "path")]
    asked = _asked(wanted, F.collect_list(F.struct(*own)).alias("asked"))
    line = lambda r: F.struct(*[r[c].alias(c) for c in own], F.get(F.col("lines"), r["line_number"] - 1).alias("line"))
    met = with_text(files.select(*keys, "content").join(asked, keys)).withColumn("lines", X.split_lines(F.col("text")))
    found = met.select(*keys, F.explode(computed(F.transform("asked", line))).alias("r")).select(*keys, "r.*")
    there = files.select(*keys).join(asked.select(*keys), keys).distinct()
    lost = asked.join(there, keys, "left_anti").select(*keys, F.explode("asked").alias("r")).select(*keys, "r.*")
    return (
        found.unionByName(lost.withColumn("line", F.lit("")))
        .select(*wanted.columns, F.coalesce("line", F.lit("")).alias("line"))
        .withColumn("stripped", X.strip(F.col("line")))
    )


def context_snippets(files: DataFrame, hits: DataFrame, around: int = 2) -> DataFrame:
    """Numbered lines around each hit line, the hit itself marked with '>>> '."""

    def snippet(number):
        first = F.greatest(F.lit(1), number - around)
        block = F.slice(F.col("lines"), first, number + around - first + 1)
        shown = F.transform(
            block,
            lambda line, i: F.concat(
                F.when(first + i == number, ">>> ").otherwise("   "),
                F.lpad((first + i).cast("string"), 3, " "),
                F.lit(" "),
                line,
            ),
        )
        return F.struct(
            number.alias("line_number"), F.array_join(shown, "\n").alias("snippet")
        )

    inside = F.filter("numbers", lambda n: n.between(1, F.size("lines")))
    return (
        _per_file(files, hits)
        .select("project_id", "path", F.explode(F.transform(inside, snippet)).alias("s"))
        .select("project_id", "path", "s.*")
    )


def _per_file(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Files that have wanted lines, with their lines and the (distinct) wanted numbers.

    The numbers of one file are at most its line count, so the group is bounded by the file.
    """
    numbers = _asked(wanted, F.collect_set("line_number").alias("numbers"))
    return with_text(files.select("project_id", "path", "content").join(
        numbers, ["project_id", "path"]
    )).withColumn("lines", X.split_lines(F.col("text"))).select(
        "project_id", "path", "numbers", "lines", F.size("lines").alias("n_lines")
    )


def _asked(wanted: DataFrame, what: F.Column) -> DataFrame:
    """One row per file of what is wanted of it, with a hint to broadcast it if it is measured to be small."""
    asked = wanted.groupBy("project_id", "path").agg(what)
    small = broadcast_if_small(asked, WANTED_ROWS, WANTED_BYTES)
    return asked if small is None else small
