"""Trees of source files: a data source that lists them, a reader that opens listed files, and a writer.

Excluded directories are never listed, wanted projects and sizes are filters the source applies itself, and names that
begin with a dot or an underscore (`__init__.py`) are files like others, which Spark's own file sources leave out.

The driver lists directories only, from the top until there are enough of them for the tasks; these list the rest, each
below its own directories, and stream rows. A file that vanishes between list and opening has null content, and a scan makes
that an error row. A directory that cannot be listed fails the job.
"""

import json
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs as FS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, LessThan, LessThanOrEqual

from codesieve.schemas import FILE

LISTED = T.StructType([f for f in FILE.fields if f.name != "content"])
_ARROW = pa.schema([("project_id", pa.string()), ("path", pa.string()), ("size_bytes", pa.int64()), ("last_modified", pa.timestamp("us", "UTC"))])
BATCH_ROWS, BATCH_BYTES = 10_000, 32 * 1024 * 1024
LISTERS = 16  # directories the driver lists at a time


def file_system(root: str) -> tuple[FS.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    elif root.startswith("s3a:"):
        root = "s3:" + root.removeprefix("s3a:")
    system, base = FS.FileSystem.from_uri(root)
    return system, base.rstrip("/")


@dataclass
class Chunk(InputPartition):
    """Directories below the root, and whether what is below them comes too."""

    directories: list[tuple[str, bool]]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.depth = int(options.get("project_depth", 0))
        self.excluded = frozenset(json.loads(options.get("excluded", "[]")))
        self.chunks = int(options.get("chunks", 64))
        self.projects: frozenset | None = None
        self.most: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            match f:
                case EqualTo(("project_id",), str(name)):
                    self._only([name])
                case In(("project_id",), names):
                    self._only(names)
                case LessThanOrEqual(("size_bytes",), int(most)):
                    self._at_most(most)
                case LessThan(("size_bytes",), int(over)):
                    self._at_most(over - 1)
                case _:
                    yield f

    def _only(self, names) -> None:
        names = frozenset(n for n in names if n is not None)
        self.projects = names if self.projects is None else self.projects & names

    def _at_most(self, size: int) -> None:
        self.most = size if self.most is None else min(self.most, size)

    def partitions(self) -> list[Chunk]:
        system, base = file_system(self.root)
        above, open_ = [], [""]
        with ThreadPoolExecutor(LISTERS) as pool:
            while open_ and len(open_) < self.chunks:
                below = pool.map(lambda d: list(self._entries(system, base, d, "directories")), open_)
                above, open_ = above + open_, [d for found in below for d in found]
        units = [(d, False) for d in above] + [(d, True) for d in open_]
        return [Chunk(units[i :: self.chunks]) for i in range(min(self.chunks, len(units)))]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        system, base = file_system(self.root)
        rows = self._rows(system, base, partition)
        while batch := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*batch), _ARROW)], schema=_ARROW)

    def _rows(self, system: FS.FileSystem, base: str, partition: Chunk) -> Iterator[tuple]:
        waiting = list(partition.directories)
        while waiting:
            directory, deep = waiting.pop()
            for entry in self._entries(system, base, directory, "all" if deep else "files"):
                if isinstance(entry, str):
                    waiting.append((entry, True))
                elif self.most is None or entry[2] <= self.most:
                    yield entry

    def _entries(self, system: FS.FileSystem, base: str, directory: str, what: str) -> Iterator:
        """Names of wanted directories and rows of wanted files directly in a directory. Links to directories are not followed."""
        local = isinstance(system, FS.LocalFileSystem)
        above = directory.split("/") if directory else []
        for info in system.get_file_info(FS.FileSelector(f"{base}/{directory}" if directory else base, allow_not_found=bool(directory))):
            parts = [*above, info.base_name]
            if len(parts) > self.depth and info.base_name in self.excluded:
                continue
            if info.type == FS.FileType.Directory:
                if what != "files" and self._may_hold(parts) and not (local and os.path.islink(info.path)):
                    yield "/".join(parts)
            elif info.type == FS.FileType.File and what != "directories" and len(parts) > self.depth:
                project = "/".join(parts[: self.depth]) if self.depth else base.rsplit("/", 1)[-1]
                if self.projects is None or project in self.projects:
                    yield project, "/".join(parts[self.depth :]), info.size, info.mtime

    def _may_hold(self, parts: list[str]) -> bool:
        if self.projects is None or not self.depth:
            return True
        mine = "/".join(parts[: self.depth])
        return mine in self.projects if len(parts) >= self.depth else any(p.startswith(mine + "/") for p in self.projects)


class SourceTree(DataSource):
    """`source_tree`: options path, project_depth, excluded (JSON list of names), chunks (tasks)."""

    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> T.StructType:
        return LISTED

    def reader(self, schema: T.StructType) -> TreeReader:
        return TreeReader(self.options)


def read_tree(spark: SparkSession, root: str, project_depth: int = 0, excluded: list[str] = (), chunks: int | None = None) -> DataFrame:
    """The files below `root` without content, as rows (project_id, path, size_bytes, last_modified).

    project_depth=0: the root is one project; n: the first n directories name the project, and files above them are none.
    `excluded`: directories (and files) of a project with one of these names are not listed.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SourceTree)
    chunks = chunks or 4 * spark.sparkContext.defaultParallelism
    reader = spark.read.format("source_tree").option("project_depth", project_depth).option("excluded", json.dumps(list(excluded)))
    return reader.option("chunks", chunks).load(root)


def open_files(listing: DataFrame, root: str, project_depth: int = 0, tasks: int | None = None) -> DataFrame:
    """Listed files with their content, dealt by a hash of their place: only the small rows of the list are shuffled."""
    spark = listing.sparkSession
    tasks = tasks or max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        for batch in batches:
            places = zip(batch["project_id"].to_pylist(), batch["path"].to_pylist())
            start, held, size = 0, [], 0
            for project, path in places:
                held.append(_content(system, f"{base}/{project}/{path}" if project_depth else f"{base}/{path}"))
                size += len(held[-1] or b"")
                if size >= BATCH_BYTES:
                    yield _with_content(batch.slice(start, len(held)), held)
                    start, held, size = start + len(held), [], 0
            yield _with_content(batch.slice(start, len(held)), held)

    schema = T.StructType([f for f in listing.schema.fields if f.name != "content"] + [FILE["content"]])
    rows = listing.select(*[n for n in schema.names if n != "content"]).repartition(tasks, "project_id", "path")
    return rows.mapInArrow(contents, schema)


def _content(system: FS.FileSystem, place: str) -> bytes | None:
    try:
        with system.open_input_stream(place) as f:
            return f.read()
    except OSError:
        return None


def _with_content(rows: pa.RecordBatch, contents: list[bytes | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(contents, pa.binary())], names=[*rows.schema.names, "content"])


def write_tree(files: DataFrame, root: str) -> int:
    """Write file rows as files `root`/project_id/path and return their number. A task that is run again writes the same files;
    each is written beside the tree and moved to its place, so no half a file is ever there. Null content is an empty file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        aside = f"{base}.writing"
        system.create_dir(aside)
        for batch in batches:
            for project, path, content in zip(*[batch[n].to_pylist() for n in ("project_id", "path", "content")]):
                place, part = f"{base}/{project}/{path}", f"{aside}/{uuid.uuid4().hex}"
                system.create_dir(place.rsplit("/", 1)[0])
                with system.open_output_stream(part) as f:
                    f.write(content or b"")
                system.move(part, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = files.select("project_id", "path", "content").mapInArrow(write, "n bigint")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
