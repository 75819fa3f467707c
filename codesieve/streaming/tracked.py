"""Tracked scan (an extension): files that appear, change and go, as a stream of versions with retraction.

An event is a version of a file: (project_id, path, size_bytes, last_modified, content, version, deleted). Keyed state holds the
last version of each file and its counts, and every newer version gives one row of differences, so the totals of a project are
plain sums of these rows and equal a fresh scan of what is there now. State and rows are a few numbers per file; no text is kept.

Events may come in any order and more than once: what is not newer than the last version seen changes nothing, and of several events of a
file in one batch the newest counts (of equal versions one that is not deleted, then the one with more findings). A deleted file keeps
its version in the state, so that a late older event does not bring it back. A file that grows over the size limit, or loses its content, counts nothing.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from codesieve.functions import scoring as S
from codesieve.operators import file_pass as FP
from codesieve.operators import scoring as SC
from codesieve.plans.scan import discover, known_language

COUNTS = list(SC.COUNTS.values())
CHANGES = ", ".join(
    ["project_id string", "path string", "version bigint", "size_bytes bigint", "last_modified timestamp", "change string", "n_files bigint"] + [f"{c} bigint" for c in COUNTS]
)
STATE = ", ".join(["version bigint", "n_files bigint"] + [f"{c} bigint" for c in COUNTS])


def file_counts(events: DataFrame, patterns: list, profiles: DataFrame, **discovery) -> DataFrame:
    """Events with their counts by severity; the source is scanned here, before anything is keyed."""
    found = discover(events, profiles=profiles, **discovery).where(known_language())
    # Content that counts nothing is not parsed; it would also be an error row of a scan.
    counts = ~F.col("deleted") & F.coalesce(F.col("size_bytes") <= F.col("max_file_size_mb") * 1024 * 1024, F.lit(False)) & F.col("content").isNotNull()
    rows = found.withColumns({"alive": counts, "content": F.when(counts, F.col("content"))})
    analyzed = FP.analyze(rows, patterns, carried=("alive", "deleted", "version", "size_bytes", "last_modified"))

    def of(severity: str) -> Column:
        return F.size(F.filter("found", lambda x: x["c"]["severity"] == severity)).cast("long")

    per_severity = [of(s).alias(c) for s, c in SC.COUNTS.items()]
    return analyzed.select(
        "project_id", "path", "version", "size_bytes", "last_modified", "deleted", F.col("alive").cast("long").alias("n_files"), *per_severity
    )


def _difference(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    # Runs once a file: values are taken one by one, since sorting or casting frames of a row or two costs far more.
    best = None
    for rows in batches:
        for i, (version, deleted, *counts) in enumerate(zip(*[rows[c].tolist() for c in ("version", "deleted", *COUNTS)])):
            rank = (version, not deleted, *counts)
            if best is None or rank >= best[0]:
                best = (rank, rows, i)
    (version, stays, *counts), rows, i = best
    before = state.get if state.exists else None
    if before is not None and version <= before[0]:
        return
    alive = rows["n_files"].iat[i]
    now = [int(x) for x in (alive, *counts)] if alive else [0] * (1 + len(COUNTS))
    state.update((int(version), *now))
    old = list(before[1:]) if before is not None else [0] * len(now)
    change = "deleted" if not stays else "added" if not old[0] else "changed"
    numbers = dict(zip(["n_files", *COUNTS], [[a - b] for a, b in zip(now, old)]))
    size = rows["size_bytes"].iat[i]
    yield pd.DataFrame(
        {"project_id": [key[0]], "path": [key[1]], "version": [int(version)], "size_bytes": [None if pd.isna(size) else int(size)], "last_modified": [rows["last_modified"].iat[i]], "change": [change], **numbers}
    )


def track(events: DataFrame, patterns: list, out: str, profiles: DataFrame, **discovery) -> None:
    """Run the waiting events to their end, adding the differences to `out/changes`.

    `profiles` are those of the projects and stay the same for a folder `out`; `discovery` takes the options of `discover`.
    Versions are numbers from 0; events without one are left out.
    """
    usable = events.where("version >= 0").withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    counted = file_counts(usable, patterns, profiles, **discovery)
    changes = counted.groupBy("project_id", "path").applyInPandasWithState(_difference, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)
    query = (
        changes.writeStream.format("parquet").outputMode("append")
        .option("path", f"{out}/changes").option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def changes(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(f"{out}/changes")


def tracked_summary(spark: SparkSession, out: str, projects: DataFrame | None = None) -> DataFrame:
    """Counts and score of what is there now: sums of all differences."""
    totals = changes(spark, out).groupBy("project_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
    penalty = sum((F.col(c) * S.penalty(F.lit(s)) for s, c in SC.COUNTS.items()), F.lit(0))
    return SC.summarize(totals.withColumn("penalty", penalty), projects)


def pending(listing: DataFrame, spark: SparkSession, out: str, version: int) -> DataFrame:
    """Events without content by which `out` would follow `listing`: files that are new or differ in size or time, and files that are gone.

    Only these need to be opened. `listing` may leave out what no scan looks at; `version` must exceed those before.
    """
    seen = changes(spark, out).groupBy("project_id", "path").agg(F.max_by(F.struct("size_bytes", "last_modified", "change"), "version").alias("s"))
    known = seen.where("s.change <> 'deleted'").select("project_id", "path", "s.size_bytes", "s.last_modified", F.lit(True).alias("known"))
    now = listing.select("project_id", "path", "size_bytes", "last_modified", F.lit(True).alias("there"))
    both = now.alias("n").join(known.alias("k"), ["project_id", "path"], "full")
    same = F.col("n.size_bytes").eqNullSafe(F.col("k.size_bytes")) & F.col("n.last_modified").eqNullSafe(F.col("k.last_modified"))
    gone = F.col("there").isNull()
    return both.where(gone | F.col("known").isNull() | ~same).select(
        "project_id", "path", "n.size_bytes", "n.last_modified", F.lit(version).cast("long").alias("version"), gone.alias("deleted")
    )
