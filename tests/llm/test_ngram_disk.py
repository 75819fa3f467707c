"""What the n-gram join leaves on disk and shuffles: tables and shuffle files of one step at a time, and no text."""

import os
import random
import time
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codesieve.llm import common, ngram_join
from codesieve.llm.common import Steps
from tests.llm.conftest import SCHEMA


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda _: f"file://{tmp_path}/{uuid.uuid4().hex}")
    return tmp_path


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def classes(docs):
    return sorted(map(tuple, ngram_join.jaccard_classes(docs, 3, 60).collect()), key=repr)


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies of which the first and last differ, so that components are joined in the search round."""
    rng = random.Random(8)
    rows = []
    for group in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(60)]
        for i in range(6):
            words[rng.randrange(60)] = f"x{group}_{i}"
            rows.append((len(rows), " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def test_only_what_the_result_reads_is_left(spark, docs, folder):
    ngram_join.jaccard_classes(docs, 3, 60)
    tables = {d for d, _, files in os.walk(folder) if "_SUCCESS" in files}
    assert len(tables) == 2


def test_shuffle_files_go_with_their_step(spark, folder):
    before, steps = shuffle_files(spark), Steps(spark)
    out = steps.stored(spark.range(1000).repartition(5, "id"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and out.count() == 1000
    steps.drop(out)
    assert not any(files for _, _, files in os.walk(folder))


def test_texts_are_not_shuffled(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    first = docs.where("doc_id < 40").select(F.col("doc_id").alias("node"), "doc_id").localCheckpoint()
    sets = ngram_join.node_sets(docs, first.select("node"), first, 3)
    assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()
    assert sets.count() >= docs.where("doc_id < 40").count()
    gone = first.where("doc_id % 2 = 0").select("doc_id")
    left = lambda rows: sorted(map(tuple, rows.collect()), key=repr)
    assert left(ngram_join.without(docs, gone)) == left(docs.join(gone, "doc_id", "left_anti").select(*docs.columns))


def test_passes_change_nothing(copies, monkeypatch):
    whole, turns = classes(copies), []
    passes = ngram_join._passes

    def few(volume, most, key):
        turns.append(passes(volume, -(-volume // 3), key))
        return turns[-1]

    monkeypatch.setattr(ngram_join, "_passes", few)
    monkeypatch.setattr(ngram_join, "MARK_BITS", 64)
    assert classes(copies) == whole
    assert [len(t) for t in turns] == [3, 3]


def test_marks_hold_all_ids(spark):
    ids = [0, -1, 2**63 - 1, -(2**63), 12345]
    marks = ngram_join.Marks(spark.createDataFrame([(i,) for i in [*ids, None]], "id long"))
    assert marks.has(pa.array([*ids, None], pa.int64())).tolist() == [True] * 5 + [False]
    assert marks.has(pa.array(range(10**6, 10**6 + 1000), pa.int64())).sum() < 50
    assert not ngram_join.Marks(spark.createDataFrame([], "id long")).has(pa.array([1], pa.int64())).any()


def test_lists_alone_name_the_candidates():
    lists = ngram_join.Lists(60)
    for node, part in ((5, 5), (6, 6), (7, 1)):
        lists.add(node, part, 20, list(range(node, node + 14)))
    assert list(lists.candidates(1, 1, 20, list(range(14)))) == [0, 1]
    assert not list(lists.candidates(9, 9, 20, list(range(14))))
    assert not list(lists.candidates(1, 1, 60, list(range(14))))


def test_stage_of_the_pipeline_leaves_texts_where_they_are(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(1500)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
        time.sleep(2)  # shuffle files of the steps are removed meanwhile
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        sizes = lambda: sum(files.getAllFiles().apply(i).length() for i in range(files.getAllFiles().size()))
        start = sizes()
        kept.write.parquet(f"{tmp_path}/kept")
        assert sizes() - start < 100_000 < sum(map(len, texts)) / 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/kept").select("doc_id").collect()) == list(range(60))
