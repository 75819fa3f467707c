"""Incremental scan (an extension): new files only, with the stateless operators of a scan.

Each micro-batch finds, de-duplicates and appends the findings of its files, since no
finding depends on another file. Roll-ups stay additive totals per batch.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from codesieve.operators import detectors as D
from codesieve.operators import file_pass as FP
from codesieve.operators import scoring as SC
from codesieve.plans.scan import discover, fact_problems, findings_of, known_language, measured, one_pass, split_oversize
from codesieve.schemas import BINARY_FILE
from codesieve.sources.files import spread, to_files


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local session that names none gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="increment-")


def stream_files(
    spark: SparkSession, root: str, project_depth: int = 0, max_files: int = 10_000
) -> DataFrame:
    """Files that appear under `root`, as a stream."""
    raw = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return to_files(raw, root, project_depth)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of files.

    A stream takes no single file for its path, but takes what a pattern finds; this one finds the path alone.
    """
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def scan_increment(
    files: DataFrame,
    patterns: list,
    out: str,
    detectors: tuple = D.DEFAULT,
    profiles: DataFrame | None = None,
    **discovery,
) -> None:
    """Run the waiting input to its end, adding to `out/findings`, `out/errors` and `out/totals`.

    Files of a batch are chosen as in a scan: by extension, exclusions, target languages, depth and
    size; `discovery` takes the options of `discover`. `profiles` are those of the projects; without
    them each batch is profiled by the files it brings.

    A batch writes its own directory and overwrites it when it is run again, so a restart
    after a lost driver neither loses nor doubles findings.
    """

    known = None if profiles is None else measured(profiles)  # once, not for every batch
    # With the syntax among the detectors one pass gives findings and problems; it is planned and run once a batch.
    together = one_pass(patterns, detectors) and D.PYTHON_SYNTAX in detectors

    def run(batch: DataFrame, batch_id: int) -> None:
        found = discover(spread(batch), profiles=known, is_measured=known is not None, **discovery)
        within, oversize = split_oversize(found)
        kept = within.where(known_language())
        if together:
            analyzed = FP.analyze(kept, patterns, tuple(d.name for d in detectors)).select("project_id", "path", "found", "problems").persist()
            findings, problems = FP.findings_of(analyzed), FP.problems_of(analyzed)
        else:
            findings, problems = findings_of(kept, patterns, detectors), fact_problems(kept)
        target = f"{out}/findings/batch={batch_id}"
        findings.write.mode("overwrite").parquet(target)
        oversize.unionByName(problems).write.mode("overwrite").parquet(f"{out}/errors/batch={batch_id}")
        written = batch.sparkSession.read.schema(findings.schema).parquet(target)
        SC.severity_totals(written).write.mode("overwrite").parquet(f"{out}/totals/batch={batch_id}")
        if together:
            analyzed.unpersist()

    query = (
        files.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def increment_findings(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/findings").drop("batch")


def increment_summary(spark: SparkSession, out: str) -> DataFrame:
    """Summary over all batches from their additive totals."""
    return SC.summarize(SC.merge_totals(spark.read.parquet(f"{out}/totals").drop("batch")))


def new_output(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/increment-{uuid.uuid4().hex}"
