"""Listing, opening and writing trees of source files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from codesieve.sources import trees as TR


def new_dir() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(root: str, sources: dict) -> None:
    for path, text in sources.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "w") as f:
            f.write(text)


TREE = {
    "p/a.py": "eval(x)\n", "p/__init__.py": "eval(y)\n", "p/.hidden.py": "", "p/src/_m.py": "x", "p/node_modules/x/i.js": "y", "p/src/venv/lib/z.py": "z",
    "node_modules/a.py": "q", "r/deep/er/and/deeper/b.py": "bb", "top.py": "t",
}


@pytest.fixture(scope="module")
def root():
    made = new_dir()
    write(made, TREE)
    os.symlink(f"{made}/p", f"{made}/p/src/loop")
    return made


def places(rows):
    return {(r.project_id, r.path) for r in rows.collect()}


def test_lists_all_files_but_those_above_the_projects(spark, root):
    every = {tuple(p.split("/", 1)) for p in TREE if "/" in p}
    for chunks in (1, 3, 100):
        assert places(TR.read_tree(spark, root, 1, chunks=chunks)) == every
    name = os.path.basename(root)
    assert places(TR.read_tree(spark, root)) == {(name, p) for p in TREE}
    sizes = {r.path: r.size_bytes for r in TR.read_tree(spark, root).collect()}
    assert sizes == {p: len(t) for p, t in TREE.items()}


@pytest.mark.parametrize("chunks", [1, 2, 50])
def test_excluded_directories_are_never_listed(root, monkeypatch, chunks):
    system, base = TR.file_system(root)
    asked = []

    class Recorder:
        def get_file_info(self, selector):
            asked.append(selector.base_dir.removeprefix(base).strip("/"))
            return [i for i in system.get_file_info(selector) if i.base_name != "loop"]

    monkeypatch.setattr(TR, "file_system", lambda _: (Recorder(), base))
    reader = TR.TreeReader({"path": root, "project_depth": "1", "excluded": '["node_modules", "venv"]', "chunks": str(chunks)})
    parts = reader.partitions()
    assert len(parts) <= chunks
    rows = [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    # A project may have an excluded name itself.
    assert sorted(r[:2] for r in rows) == sorted(tuple(p.split("/", 1)) for p in TREE if "/" in p and "/node_modules/" not in p and "/venv/" not in p)
    assert not any(d.startswith(("p/node_modules", "p/src/venv")) for d in asked) and "p/src" in asked


def test_projects_and_sizes_are_filters_of_the_source(spark, root):
    listing = TR.read_tree(spark, root, 1)
    mine = listing.where((F.col("project_id") == "p") & (F.col("size_bytes") <= 1))
    assert "<= 1" not in mine._jdf.queryExecution().executedPlan().toString()
    assert places(mine) == {("p", ".hidden.py"), ("p", "src/_m.py"), ("p", "node_modules/x/i.js"), ("p", "src/venv/lib/z.py")}
    assert places(listing.where(F.col("project_id").isin("r", "none"))) == {("r", "deep/er/and/deeper/b.py")}
    assert places(listing.where("project_id = 'p' AND project_id = 'r'")) == set()
    assert places(listing.where("size_bytes < 1")) == {("p", ".hidden.py")}
    # Filters the source does not know are Spark's.
    assert places(listing.where("path LIKE 'deep%'")) == {("r", "deep/er/and/deeper/b.py")}
    two = TR.read_tree(spark, root, 2).where("project_id = 'p/src'")
    assert places(two) == {("p/src", "_m.py"), ("p/src", "venv/lib/z.py")}


def test_opened_files_have_their_bytes_and_lost_ones_none(spark, root, monkeypatch):
    monkeypatch.setattr(TR, "BATCH_BYTES", 3)
    rows = {(r.project_id, r.path): bytes(r.content) for r in TR.open_files(TR.read_tree(spark, root, 1), root, 1).collect()}
    assert rows == {tuple(p.split("/", 1)): t.encode() for p, t in TREE.items() if "/" in p}
    gone = TR.read_tree(spark, root, 1).limit(1).withColumn("path", F.lit("not/there.py"))
    assert [r.content for r in TR.open_files(gone, root, 1).collect()] == [None]


def test_written_tree_reads_back(spark, make_files):
    files = make_files({"a.py": "x\n", "b/ü c.py": "é", "empty.py": ""}).unionByName(make_files({"a.py": "other"}, "q"))
    target = f"{new_dir()}/tree"
    assert TR.write_tree(files, target) == 4
    assert TR.write_tree(files, target) == 4
    back = TR.open_files(TR.read_tree(spark, target, 1), target, 1)
    assert sorted(map(str, back.drop("last_modified").collect())) == sorted(map(str, files.drop("last_modified").collect()))
    assert os.listdir(f"{target}.writing") == []
    assert TR.write_tree(files.where("false"), f"{new_dir()}/none") == 0


def test_empty_and_missing_roots(spark):
    assert TR.read_tree(spark, new_dir(), 1).count() == 0
    with pytest.raises(Exception, match="none-such"):
        TR.read_tree(spark, f"{new_dir()}/none-such").count()


def test_scan_of_a_directory_sees_underscored_files_and_skips_excluded_ones(spark, root):
    from codesieve.plans.scan import scan_directory

    found = {(r.project_id, r.file_path) for r in scan_directory(spark, root, 1).findings.collect()}
    assert {("p", "__init__.py"), ("p", "a.py")} <= found and not any("venv" in path for _, path in found)
    pruned = scan_directory(spark, root, 1, pruned=True)
    assert {(r.project_id, r.file_path) for r in pruned.findings.collect()} == found
    listed = {r.project_id: r.files_in for r in pruned.accounting.collect()}
    assert listed["p"] == 4
