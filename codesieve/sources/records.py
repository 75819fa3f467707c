"""Result records: report, statistics and errors of every project, as a sink with a commit of its own.

A record is a document `{"report", "stats", "errors"}` of about `part_size` findings and as many errors, so a project of any size
is many records and no task gathers one. Tasks write pieces of JSON lines under names of their own; the commit, which sees one short
message a task, names the pieces of the attempts that count in `_records.json` and replaces that file in one move. Until then readers
see what was committed before. Pieces of attempts that were run again are removed, and so are those of a failed job; what tasks still running
at its abort write later counts for nothing and goes at the next commit. One job may write to a folder at a time.
"""

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as FS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from codesieve.schemas import DOUBLE, INT, LONG, REPORT_JSON, TEXT, TEXTS, struct
from codesieve.sources import reports as RP
from codesieve.sources.trees import file_system

MANIFEST = "_records.json"
# Documents that a task's Python holds at once; they are as long as hundreds of findings, where Spark's batches are of 10,000 rows.
BATCH_ROWS, BATCH_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch", 32
STATS = ["files_analyzed", "files_skipped", "rules_applied", "rules_triggered", "total_lines_scanned"]
STATS_JSON = struct(**{n: LONG for n in STATS})
RECORD_LINE = struct(project_id=TEXT, part=INT, n_parts=INT, record=struct(report=REPORT_JSON, stats=STATS_JSON, errors=TEXTS))
RECORD = struct(project_id=TEXT, part=INT, n_parts=INT, json=TEXT)


def record_parts(
    findings: DataFrame, errors: DataFrame, stats: DataFrame, projects: DataFrame, started_at=None, part_size: int = RP.PART_SIZE
) -> DataFrame:
    """(project_id, part, n_parts, json): the records of all projects. `found_at` of a finding that has none is the start of the scan."""
    started = F.lit(started_at).cast("timestamp") if started_at else F.current_timestamp()
    found = RP.with_found_at(findings)
    found = found.withColumn("found_at", F.coalesce("found_at", started))
    per_project = errors.groupBy("project_id").agg(F.count("*").alias("n_rows"))
    reports = RP.report_parts(found, projects, started_at, part_size=part_size, more=per_project)
    said = F.coalesce("message", F.concat_ws(": ", "path", "reason"))
    place = F.conv(F.substring(F.md5(F.coalesce("path", "reason").cast("binary")), 1, 8), 16, 10).cast("long")
    numbers = reports.where("part = 0").select("project_id", "n_parts")
    dealt = errors.select("project_id", place.alias("place"), said.alias("said")).join(numbers, "project_id")
    dealt = dealt.groupBy("project_id", (F.col("place") % F.col("n_parts")).cast("int").alias("part")).agg(F.array_sort(F.collect_list("said")).alias("errors"))
    rows = reports.join(dealt, ["project_id", "part"], "left").join(stats.select("project_id", *STATS), "project_id", "left")
    document = F.concat(
        F.lit('{"report":'), F.col("json"),
        F.lit(',"stats":'), F.to_json(F.struct(*[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in STATS])),
        F.lit(',"errors":'), F.to_json(F.coalesce("errors", F.array().cast("array<string>"))), F.lit("}"),
    )
    return rows.select("project_id", "part", "n_parts", document.alias("json"))


@dataclass
class Piece(WriterCommitMessage):
    """What one attempt of a task wrote: its file below the root (empty if no row came) and its rows."""

    place: str
    n_records: int


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite, self.job, self.started = root, overwrite, f"job-{uuid.uuid4().hex}", time.time()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Piece:
        system, base = file_system(self.root)
        place, stream, n = f"{self.job}/piece-{uuid.uuid4().hex}.jsonl", None, 0
        try:
            for batch in iterator:
                if stream is None:
                    system.create_dir(f"{base}/{self.job}")
                    stream = system.open_output_stream(f"{base}/{place}")
                columns = [batch.column(k) for k in ("project_id", "part", "n_parts", "json")]
                for project, part, n_parts, document in zip(*columns):  # one document at a time becomes a string
                    head = json.dumps({"project_id": project.as_py(), "part": part.as_py(), "n_parts": n_parts.as_py()}, ensure_ascii=False)
                    stream.write(f'{head[:-1]}, "record": '.encode())
                    stream.write(document.as_buffer())
                    stream.write(b"}\n")
                    n += 1
        finally:
            if stream is not None:
                stream.close()
        return Piece(place if n else "", n)

    def commit(self, messages: list[Piece | None]) -> None:
        system, base = file_system(self.root)
        system.create_dir(base)
        pieces = [m for m in messages if m is not None and m.n_records]
        job = {
            "job": self.job, "execution_time": round(time.time() - self.started, 3),
            "pieces": sorted(p.place for p in pieces), "n_records": sum(p.n_records for p in pieces),
        }
        before = committed(self.root)
        part = f"{base}/.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(json.dumps({"jobs": [job] if self.overwrite else [*before, job]}).encode())
        system.move(part, f"{base}/{MANIFEST}")
        named = {p.place for p in pieces}
        if pieces:
            for info in system.get_file_info(FS.FileSelector(f"{base}/{self.job}")):
                if f"{self.job}/{info.base_name}" not in named:
                    system.delete_file(info.path)
        counts = {self.job, *([] if self.overwrite else [j["job"] for j in before])}
        for info in system.get_file_info(FS.FileSelector(base)):
            if info.base_name.startswith("job-") and info.base_name not in counts:
                system.delete_dir(info.path)

    def abort(self, messages: list[Piece | None]) -> None:
        system, base = file_system(self.root)
        if system.get_file_info(f"{base}/{self.job}").type == FS.FileType.Directory:
            system.delete_dir(f"{base}/{self.job}")


class Records(DataSource):
    """`result_records`: rows of RECORD into the folder `path`."""

    @classmethod
    def name(cls) -> str:
        return "result_records"

    def schema(self) -> T.StructType:
        return RECORD

    def writer(self, schema: T.StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], overwrite)


def write_records(records: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Write the records of `record_parts`; mode "append" keeps those of earlier jobs."""
    conf = records.sparkSession.conf
    records.sparkSession.dataSource.register(Records)
    rows, before = records.select(*[F.col(f.name).cast(f.dataType) for f in RECORD.fields]), conf.get(BATCH_ROWS)
    conf.set(BATCH_ROWS, BATCH_RECORDS)
    try:
        rows.write.format("result_records").mode(mode).save(root)
    finally:
        conf.set(BATCH_ROWS, before)


def committed(root: str) -> list[dict]:
    """Jobs that count, in the order of their commits; none where nothing was ever committed."""
    system, base = file_system(root)
    if system.get_file_info(f"{base}/{MANIFEST}").type != FS.FileType.File:
        return []
    with system.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())["jobs"]


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """(job, execution_time, project_id, part, n_parts, report, stats, errors) of committed records; `execution_time` is that of their whole job."""
    jobs = committed(root)
    empty = spark.createDataFrame([], RECORD_LINE)
    out = empty.select(F.lit("").alias("job"), F.lit(0.0).cast(DOUBLE).alias("execution_time"), "project_id", "part", "n_parts", "record.*")
    for job in jobs:
        if job["pieces"]:
            lines = spark.read.schema(RECORD_LINE).json([f"{root}/{p}" for p in job["pieces"]])
            out = out.unionByName(
                lines.select(F.lit(job["job"]).alias("job"), F.lit(job["execution_time"]).cast(DOUBLE).alias("execution_time"), "project_id", "part", "n_parts", "record.*")
            )
    return out
