"""The numbered queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    chat_format,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    pii,
    prefix_trie,
    quality,
    sharding,
    simhash,
    substring_dedup,
    topk,
    warc_zip,
)
from tripweave.llm.common import table
from tripweave.llm.oracle import ORACLES as ORACLES
from tripweave.session import stage

# The sequence length and the vocabulary of the packed corpus.
SEQUENCE_TOKENS = 4096
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(), SEQUENCE_TOKENS)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1, counts=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc_zip.package_folder(pages)
    packages = warc_zip.write_packages(pages, folder)
    return warc_zip.read_records(packages, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# Target shares by language and topic; they leave nothing, so what is named in neither
# keeps its share of the tokens.
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
TOPICS = {"contact": 0.1, "short": 0.1, "long": 0.8}
# The part of all tokens to sample, and the power of a source's tokens that is its target.
KEEP, FLATTEN = 0.5, 0.7


def topic_of(text: Column) -> Column:
    """A document's topic class by its content."""
    return (
        F.when(text.rlike(r"@|[0-9]{4}"), "contact").when(F.length(text) < 1000, "short").when(text.isNotNull(), "long")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed(docs, LANGUAGES, TOPICS, topic_of(F.col("text")), KEEP, FLATTEN)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"), "judged"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, table(spark, sf_dir, "labels"), ["doc_id"]).select(
        "document.doc_id", *[f"stats.{c}" for c in quality.RULES], "base_failed", "kept"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select(*planted.columns).unionByName(planted)
    return chat_format.read_back(chat_format.format_turns(turns))


def with_shared_openings(paths: DataFrame) -> DataFrame:
    """Conversations that begin with up to eight turns of the one whose id is the multiple of five next to theirs towards zero."""
    at_most = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    base = paths.filter(F.col("conv_id") % 5 == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, 8).alias("_opening")
    )
    opening = F.coalesce("_opening", F.slice("turns", 1, 0))
    return (
        paths.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 5)
        .join(base, "_base", "left")
        .select("conv_id", F.concat(F.slice(opening, 1, at_most), F.slice("turns", at_most + 1, F.size("turns"))).alias("turns"))
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = stage(prefix_trie.paths(table(spark, sf_dir, "conversations")), "conversation-paths")
    return prefix_trie.prefix_trie(with_shared_openings(paths))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        h.alias("_h"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))).alias("_words"),
    )
    g, n = F.floor(F.col("_h") / 10), F.size("_words")
    placed = words.withColumn("_a", F.when(n > 0, (g % n).cast("int"))).withColumn(
        "_p", F.when(n > 0, (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int"))
    )
    a, p = F.col("_a"), F.col("_p")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("_words", a + 1, p), times)), 1, n - a)
    repeated = F.concat_ws(" ", F.slice("_words", 1, a), tail)
    return placed.select("doc_id", F.when(a.isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")), powers=4, min_words=6)
    longer = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(longer(r, best), r).otherwise(best),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc_zip": op3_warc_zip,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_topk": op8_topk,
    "op9_simhash": op9_simhash,
    "op10_sharding": op10_sharding,
    "op11_chat_format": op11_chat_format,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
