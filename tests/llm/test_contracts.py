"""Every numbered query against a plain reading of its contract, over odd rows and over the small tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import brute
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripweave.llm import mixing, pii, quality, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as columns of the documents.
CLASHING = ["_k1", "size", "shard", "n_lines", "n_dropped", "stats", "document", "kept", "row", "chunk", "tokens"]


def vocabulary():
    return queries.vocabulary_path()


def prose(rng, n, words=300):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else f"w{rng.randrange(words)}" for _ in range(n))


def odd_texts():
    rng = random.Random(3)
    long = prose(rng, 3000)
    passage = prose(rng, 60)
    base = prose(rng, 120).split()
    near = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in range(12)]
    line = "All rights\treserved, really."
    texts = [None, "", " ", "\n", "\n\n", "one", "two words", long, long, long + " more", "x" * 50_000]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 30) for _ in range(5)]
    texts += [passage + " " + passage, *near, " ".join(base), " ".join(base).upper()]
    texts += [f"{prose(rng, 30)}\n  {line.upper() if i % 2 else line} \n{prose(rng, 20)}" for i in range(11)]
    texts += [f"ÄÖÜ ß {i}\x1c \x85 É́ 日本語 it's they're <|endoftext|> 😀!!, " * 6 for i in range(3)]
    texts += ["mail a.b+c@d-e.example.org, or x@y and z@w.co.uk.", "a@b.c_d@e.f", "ip 10.0.0.1 or 999.1.1.1 or 1.2.3.4.5.6.7.8"]
    texts += ["card 4111 1111 1111 1111, 4111-1111-1111-1112", "call +1 (606) 555-7814 or 606-555-7814. +49 30", "5" * 5000]
    texts += ["😀 +1 606 555 7814 é a@b.cd", "$$$ ### | | " * 40, "Word Word Word " * 60, "AN!! UP!! " * 30]
    texts += ["a b c d e f g h " * 8, "l1 a\nl1 a\nl2 b\n\nl1 a " + prose(rng, 30)]
    return texts


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder of tables with nulls, ties, repeated rows, long texts and columns whose names clash."""
    folder = tmp_path_factory.mktemp("odd")
    texts = odd_texts()
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], [None, "a", "a", "b"][i % 4], None) for i, t in enumerate(texts)]
    rows += [(None, texts[7], "en", "a", 1), (None, None, None, None, None), (3, "same id " * 30, "en", "b", 2), rows[12], rows[12]]
    docs = spark.createDataFrame(rows, DOCS)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("x"))
    # Names with dots and backticks, and types that have no hash.
    docs = docs.withColumns(
        {"a.b": F.lit(1), "c`d": F.lit(2), "tags": F.create_map(F.lit("k"), "lang")}
    ).withColumn("nested", F.array(F.struct("tags")))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, [1, 0, None][i % 3], 0) for i in range(40)] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    pages = [(i, f"http://x/{i}", ["<p>é</p>" * 9, None, "", "<b>", f"<i>{i}</i>"][i % 5]) for i in range(40)]
    pages += [(None, None, "<b>"), (None, "http://y\r\nz", "only without id"), (39, "http://x/39", "<i>39</i>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1)).write.parquet(
        f"{folder}/pages.parquet"
    )
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-0.5, 0.25, 0.5, 0.1]) for _ in range(4)]) for i in range(260)]
    vectors += [(300, None), (400, [1.0, None, 0.0, 0.0]), (500, [float("nan")] * 4), (600, [1.0, 2.0]), (601, [0.5, 0.5])]
    vectors += [(None, [9.0] * 4), (700, []), (100, [0.5] * 4), (7, [0.5] * 4), (701, [math.inf] * 4)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).write.parquet(
        f"{folder}/embeddings.parquet"
    )
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in {
        "documents": DOCS,
        "labels": "doc_id long, quality int, toxic int",
        "pages": "page_id long, url string, html string",
        "embeddings": "vec_id long, embedding array<float>, label int",
        "conversations": "conv_id long, turn long, role string, text string",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(folder, table, *columns):
    frame = pq.read_table(f"{folder}/{table}.parquet", columns=list(columns))
    return list(zip(*[c.to_pylist() for c in frame.columns], strict=True))


def documents(folder):
    return rows_of(folder, "documents", "doc_id", "text")


def result(spark, name, folder, *columns):
    return Counter(tuple(r) for r in queries.QUERIES[name](spark, folder).select(*columns).collect())


FOLDERS = ["odd", "sf_dir"]


@pytest.fixture(params=FOLDERS)
def folder(request):
    return request.getfixturevalue(request.param)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    df = queries.QUERIES[name](spark, empty)
    assert df.count() == (name == "op11_chat_format")  # which adds a conversation of its own
    assert df.columns


def test_op1_packing(spark, folder):
    packed = [tuple(r) for r in queries.op1_packing(spark, folder).collect()]
    want = brute.pieces(documents(folder), vocabulary(), 4096)
    assert Counter(r[:5] for r in packed) == Counter(want)
    held = {}
    for r in packed:
        held.setdefault(r[5], []).append((r[6], r[3]))
    for inside in held.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 4096
    # No packing needs fewer than the tokens fill; this one may open one more in a hundred.
    least = math.ceil(sum(r[3] for r in packed) / 4096)
    assert len(held) <= math.ceil(1.01 * least) + 1


def test_op2_line_dedup(spark, folder):
    got = result(spark, "op2_line_dedup", folder, "doc_id", "n_lines", "n_dropped", "kept_sha256")
    want = Counter(brute.dedup_lines(documents(folder)))
    assert got == want
    assert any(r[2] for r in want) or folder.endswith("0.001")


def test_op3_warc_zip(spark, folder):
    got = result(spark, "op3_warc_zip", folder, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == Counter(brute.warc(rows_of(folder, "pages", "page_id", "html")))


def test_op4_probabilities_and_draws(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in queries.op4_mixing(spark, sf_dir).collect()}
    want = brute.mixing(docs, queries.LANGUAGES, queries.TOPICS, queries.KEEP, queries.FLATTEN)
    assert len(got) == len(docs)
    for d, (language, topic, tokens, probability) in zip(docs, want, strict=True):
        r = got[d["doc_id"]]
        assert (r["language"], r["topic"], r["tokens"], r["converged"]) == (language, topic, tokens, True)
        assert not tokens or r["probability"] == pytest.approx(probability, rel=5e-3)
        assert r["sampled"] == (brute.drawn(d["doc_id"]) < r["probability"])


def test_targets_that_contradict_each_other_are_told(spark):
    rows = [(i, "word " * 30, "en" if i % 2 else "de", "s") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    topic = F.when(F.col("lang") == "en", "first").otherwise("second")
    with pytest.warns(UserWarning, match="off their targets"):
        got = mixing.mixed(docs, {"en": 0.7, "de": 0.3}, {"first": 0.3, "second": 0.7}, topic, 0.3, 1.0)
    assert {r["converged"] for r in got.select("converged").distinct().collect()} == {False}


def test_op5_pii_base_spans(spark, folder):
    counts = [f"n_{k}" for k in pii.KINDS]
    found = queries.op5_pii(spark, folder).select("doc_id", *counts, "base_sha256", "spans").collect()
    want = brute.pii(documents(folder))
    assert Counter(tuple(r)[:-1] for r in found) == Counter(w[:-1] for w in want)
    spans = Counter((r["doc_id"], s) for r in found for s in r["spans"].split(",") if s)
    assert not Counter((w[0], s) for w in want for s in w[-1]) - spans


def test_op6_quality_counts(spark, folder):
    got = result(spark, "op6_quality", folder, "doc_id", *quality.RULES, "base_failed")
    assert got == Counter(brute.quality(documents(folder)))
    kept = queries.op6_quality(spark, folder).filter("base_failed and kept").count()
    assert kept == 0


def test_op7_substring_dedup(spark, folder):
    got = result(spark, "op7_substring_dedup", folder, "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(brute.remove_repeats(documents(folder)))


def test_op8_topk(spark, folder):
    got = result(spark, "op8_topk", folder, "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_k(rows_of(folder, "embeddings", "vec_id", "embedding"), 100, 10))


def test_op9_simhash(spark, folder):
    got = result(spark, "op9_simhash", folder, "doc_id", "fingerprint", "component_id")
    assert got == Counter(brute.simhash(documents(folder)))


def test_op10_sharding(spark, folder):
    rows = queries.op10_sharding(spark, folder).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(brute.sizes(documents(folder)))
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    sizes = Counter()
    for shard in range(24):
        inside = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
        sizes[shard] = sum(r["size"] for r in inside)
    assert {r["shard"] for r in rows} <= set(range(24))
    # A row can't be cut, so a shard may miss its share by the largest row, and by a little for whole groups.
    share, largest = sum(sizes.values()) / 24, max(r["size"] for r in rows)
    assert all(abs(s - share) <= largest + 0.04 * share for s in sizes.values())


def test_op4_mixing_meets_its_targets(spark, sf_dir):
    rows = queries.op4_mixing(spark, sf_dir).toPandas()
    assert len(rows) == len(documents(sf_dir))
    words = {d: len(brute.WORD.findall(t or "")) for d, t in documents(sf_dir)}
    assert all(words[d] == n for d, n in zip(rows.doc_id, rows.tokens, strict=True))
    rows["expected"] = rows.probability * rows.tokens
    total = rows.tokens.sum()
    assert rows.probability.between(0, 1).all()
    flat = rows.groupby("source").tokens.sum() ** queries.FLATTEN
    target = flat / flat.sum() * queries.KEEP * total
    expected, owned = rows.groupby("source").expected.sum(), rows.groupby("source").tokens.sum()
    for source in target.index:
        assert expected[source] == pytest.approx(min(target[source], owned[source]), rel=1e-6)
    if (target <= owned).all():
        assert expected.sum() == pytest.approx(queries.KEEP * total, rel=1e-6)
    for column, targets in (("language", queries.LANGUAGES), ("topic", queries.TOPICS)):
        share = rows.groupby(column).expected.sum() / rows.expected.sum()
        owned = rows.groupby(column).tokens.sum().to_dict()
        wanted = mixing.within_reach(targets, owned, queries.KEEP * total)
        assert all(share.get(c, 0.0) == pytest.approx(t, rel=0.01) for c, t in wanted.items())
    assert (rows[rows.probability == 1].sampled).all() and not (rows[rows.probability == 0].sampled).any()


def test_op4_mixing_keeps_every_row(spark, odd):
    rows = queries.op4_mixing(spark, odd).collect()
    assert len(rows) == len(documents(odd))
    assert all(0 <= r["probability"] <= 1 for r in rows)


def test_word_count_is_that_of_the_contracts(spark):
    texts = [(t,) for t in odd_texts()]
    got = spark.createDataFrame(texts, "text string").select(mixing.word_count(F.col("text"))).collect()
    assert [r[0] for r in got] == [len(brute.WORD.findall(t or "")) for (t,) in texts]
