"""The pipeline stage by stage, against plain readings, with odd rows and without any."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripweave.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def through(spark, tmp_path_factory):
    """The documents before and after every stage, stored and read again, with one more column that clashes."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("tokens", F.lit("mine"))
    states = [docs]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name.replace(" ", "-"))
        function(spark, states[-1], folder).write.parquet(path)
        states.append(spark.read.parquet(path))
    return states


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_return_the_columns_of_documents(through):
    for state in through[:-1]:
        assert state.columns == [*COLUMNS, "tokens"]
        assert {r[0] for r in state.select("tokens").distinct().collect()} == {"mine"}


def test_quality_keeps_what_its_query_keeps(spark, through):
    kept = {r["doc_id"] for r in queries.op6_quality(spark, "/root/testdata/sf0.01").filter("kept").collect()}
    assert {d for d, _ in pairs(through[1])} == kept
    texts = dict(pairs(through[0]))
    assert all(texts[d] == t for d, t in pairs(through[1]))


def test_lines_are_dropped_over_what_is_left(through):
    want = brute.dedup_lines(pairs(through[1]))
    got = Counter((d, brute.sha256(t)) for d, t in pairs(through[2]))
    assert got == Counter((d, sha) for d, _, _, sha in want)


def test_one_of_each_component_stays(through):
    before = pairs(through[2])
    smallest = {c for _, _, c in brute.simhash(before)}
    texts = dict(before)
    assert Counter(pairs(through[3])) == Counter((d, texts[d]) for d in smallest)


def test_mixing_samples_what_is_left(through):
    before, after = dict(pairs(through[3])), dict(pairs(through[4]))
    assert all(before[d] == t for d, t in after.items())
    words = lambda docs: sum(len(t.split()) for t in docs.values())
    assert 0.35 < words(after) / words(before) < 0.65


def test_packing_takes_every_token(through):
    want = brute.pieces(pairs(through[4]), queries.vocabulary_path(), 4096)
    got = through[5].select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_run_gives_the_same_pieces(spark, through):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.01").select("doc_id", "piece", "ids_crc32").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, through[5].select("doc_id", "piece", "ids_crc32").collect()))


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_tables(spark, tmp_path, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _k1 string, document string"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "x", "y"), (1, "", "en", "a", 0, "x", "y")]
    rows += [(2, "word " * 30_000, None, "a", 1, "x", "y"), (None, "some words here " * 9, "xx", None, 3, "x", "y")]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    name, function = corpus_pipeline.STAGES[stage]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        out = function(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
        found = out.collect()
        assert data or not found
        if stage < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
