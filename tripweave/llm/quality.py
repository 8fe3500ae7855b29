"""Quality rules over whole texts, and an isolation forest on their statistics.

Every document gets the counts the rules need. Rules with fixed limits reject documents outright. The rest is judged by
an isolation forest: trees of random splits on the statistics, in which unusual documents end up alone after few splits.
The forest is grown on a bounded sample, its trees see ``TREE_ROWS`` documents each, and every document is scored.

The threshold comes from the labelled documents: their scores are counted in bins by label over the whole table, and
the lowest score is taken above which at most ``CLEAN_LOSS`` of the good documents lie. Only a threshold that separates
is used: without labels of both kinds on documents that pass the rules, or if it would catch bad documents no more often than good ones, the forest rejects nothing.

Defined results: a null or empty text has no words and is rejected by the rules; a null id is scored like any other
and has no label; a document with several labels counts once for each; rows that repeat are each scored; an empty table
gives no rows; other columns pass through untouched where documents are returned, and are not read elsewhere.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import texts_of
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

# Documents the forest is grown on, on average, documents per tree, trees, and the seed of their splits.
SAMPLE_ROWS = 16_384
TREE_ROWS = 256
TREES = 200
SEED = 7
# Bins of scores between 0 and 1, and the part of the good documents that may be lost to the threshold.
SCORE_BINS = 2000
CLEAN_LOSS = 0.001

RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# The usual range of each statistic the forest looks at. What counts is how far a document lies outside;
# inside, the statistics of short texts vary by chance alone.
USUAL = {
    "word_length": (3.0, 10.0),
    "symbol_share": (0.0, 0.02),
    "repeat_share": (0.0, 0.3),
    "dup_line_share": (0.0, 0.4),
    "capital_share": (0.0, 0.2),
    "exclaim_share": (0.0, 0.1),
    "stutter_share": (0.0, 0.1),
}
FEATURES = list(USUAL)
STATISTICS = ", ".join([f"{c} long" for c in RULES] + [f"{c} double" for c in FEATURES])


def repeated_words(codes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a run of ``width`` words which occurs at least twice.

    Runs are numbered exactly: twice as long ones are pairs of the numbers of their halves.
    """
    n = len(codes) - width + 1
    if n < 2:
        return 0
    run, length = codes.astype(np.int64), 1
    while length < width:
        step = min(length, width - length)
        pair = run[: len(run) - step] * (int(run.max()) + 1) + run[step:]
        run = np.unique(pair, return_inverse=True)[1]
        length += step
    again = np.flatnonzero(np.bincount(run)[run] > 1)
    if not len(again):
        return 0
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    change[again] += 1
    change[again + width] -= 1
    return int((np.cumsum(change[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple:
    """The counts of the rules, and for the forest how far the document's shares lie outside their usual ranges."""
    words = text.split()
    n = len(words)
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    continuing = len(text) - len(text.translate(None, CONTINUING))
    chars = sum(map(len, words)) - continuing
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(BLANK)]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(codes) if n >= WINDOW else 0
    capitals = len(text) - len(text.translate(None, CAPITALS))
    shares = (
        chars / n if n else USUAL["word_length"][0],
        symbols / max(chars, 1),
        repeated / max(n, 1),
        dup_lines / max(len(lines), 1),
        capitals / max(chars, 1),
        text.count(b"!") / max(n, 1),
        float((codes[1:] == codes[:-1]).sum()) / max(n, 1),
    )
    outside = [x - min(max(x, low), high) for x, (low, high) in zip(shares, USUAL.values(), strict=True)]
    return (n, chars, symbols, dup_lines, repeated, *outside)


# Bytes inside a UTF-8 character, the blanks that part words, and the capitals of ASCII.
CONTINUING = bytes(range(0x80, 0xC0))
BLANK = b" \t\n\x0b\x0c\r"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns to keep as one struct ``document``, and the struct ``stats`` of every row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("document"), F.col(text).cast("string"))
    struct = T.StructType.fromDDL(STATISTICS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * len(RULES) + [pa.float64()] * len(FEATURES)
        for batch in batches:
            columns = list(zip(*map(statistics, texts_of(batch[1])), strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            stats = pa.StructArray.from_arrays(arrays, RULES + FEATURES)
            yield pa.RecordBatch.from_arrays([batch[0], stats], ["document", "stats"])

    return rows.mapInArrow(count, T.StructType([rows.schema["document"], T.StructField("stats", struct)]))


class Forest:
    """Isolation trees in arrays: a node's feature (-1 in a leaf), split, right child, and the path length of leaves.

    The left child of a node is the next one.
    """

    def __init__(self, rows: np.ndarray, trees: int, tree_rows: int, seed: int):
        random = np.random.default_rng(seed)
        self.expected = unsuccessful(min(tree_rows, len(rows)))
        self.trees = []
        depth = int(np.ceil(np.log2(max(2, min(tree_rows, len(rows))))))
        for _ in range(trees):
            some = rows[random.choice(len(rows), min(tree_rows, len(rows)), replace=False)]
            nodes: list[list[float]] = []
            self._grow(some, 0, depth, random, nodes)
            feature, split, right, length = np.array(nodes).T
            self.trees.append((feature.astype(np.int64), split, right.astype(np.int64), length))

    def _grow(self, rows: np.ndarray, level: int, depth: int, random, nodes: list) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        varied = np.flatnonzero(high > low)
        if level == depth or not len(varied):
            nodes.append([-1, 0.0, 0, level + unsuccessful(len(rows))])
            return
        feature = random.choice(varied)
        split = random.uniform(low[feature], high[feature])
        here = len(nodes)
        nodes.append([feature, split, 0, 0.0])
        left = rows[:, feature] <= split
        self._grow(rows[left], level + 1, depth, random, nodes)
        nodes[here][2] = len(nodes)
        self._grow(rows[~left], level + 1, depth, random, nodes)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the mean path to a row's leaf, the higher."""
        total = np.zeros(len(rows))
        for feature, split, right, length in self.trees:
            node = np.zeros(len(rows), dtype=np.int64)
            inner = np.flatnonzero(feature[node] >= 0)
            while len(inner):
                at = node[inner]
                left = rows[inner, feature[at]] <= split[at]
                node[inner] = np.where(left, at + 1, right[at])
                inner = inner[feature[node[inner]] >= 0]
            total += length[node]
        return 2.0 ** (-total / (len(self.trees) * max(self.expected, 1e-9)))


def unsuccessful(n: int) -> float:
    """The mean path length of an unsuccessful search in a tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def base_failed():
    """The rules with fixed limits."""
    n, repeated = F.col("stats.n_words"), F.col("stats.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def grow_forest(rows: DataFrame, key: str) -> Forest | None:
    """A forest on about ``SAMPLE_ROWS`` of the documents that pass the rules, drawn by their hashes."""
    features = [F.col(f"stats.{f}") for f in FEATURES]
    passed = rows.filter(~base_failed())
    chance = F.lit(SAMPLE_ROWS / max(1, passed.count()))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), F.col("document")[key], *features), F.lit(2**40)) / F.lit(float(2**40))
    some = sorted(passed.filter(drawn < chance).select(*features).collect())
    return Forest(np.array(some, dtype=np.float64), TREES, TREE_ROWS, SEED) if len(some) > 1 else None


def with_scores(rows: DataFrame, forest: Forest | None) -> DataFrame:
    """Add the anomaly score; no forest gives zero."""
    if forest is None:
        return rows.withColumn("score", F.lit(0.0))

    @F.pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.scores(features.to_numpy(dtype=np.float64)))

    return rows.withColumn("score", score(F.struct(*[F.col(f"stats.{f}") for f in FEATURES])))


def threshold(scored: DataFrame, labels: DataFrame, key: str, clean_loss: float = CLEAN_LOSS) -> float:
    """A score above which at most ``clean_loss`` of the good labelled documents lie, in the middle of the gap between
    the scores below and above. One row per bin and label comes to the driver."""
    known = labels.filter(F.col("quality").isNotNull()).select(F.col(key).alias("_id"), (F.col("quality") > 0).alias("good"))
    bins = (
        scored.filter(~base_failed())
        .select(
            F.col("document")[key].alias("_key"),
            F.least(F.floor(F.col("score") * SCORE_BINS), F.lit(SCORE_BINS - 1)).alias("bin"),
        )
        .join(known, F.col("_key") == F.col("_id"))
        .groupBy("bin", "good")
        .count()
        .collect()
    )
    count = {True: np.zeros(SCORE_BINS + 1), False: np.zeros(SCORE_BINS + 1)}
    for r in bins:
        count[r["good"]][r["bin"]] = r["count"]
    if not (count[True].any() and count[False].any()):
        return float("inf")
    above = {good: c[::-1].cumsum()[::-1] for good, c in count.items()}
    total = {good: max(c.sum(), 1) for good, c in count.items()}
    cut = int(np.flatnonzero(above[True] <= clean_loss * total[True])[0])
    if above[False][cut] / total[False] <= above[True][cut] / total[True]:
        return float("inf")
    following = np.flatnonzero(count[True][cut:] + count[False][cut:])
    return (cut + float(following[0]) / 2) / SCORE_BINS


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``document`` with the columns to keep (the key among them), ``stats``, ``score``, ``base_failed``, ``kept``."""
    rows = stage(with_statistics(docs, keep, text), "statistics")
    scored = with_scores(rows, grow_forest(rows, key))
    limit = threshold(scored, labels, key)
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < limit)
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that neither the rules nor the forest reject, with all their columns."""
    return judge(docs, labels, docs.columns, key, text).filter("kept").select("document.*")
