"""Passages that occur earlier in the corpus, found through difference-cover anchors and removed word by word.

A window is a run of ``window`` words of one document; it is repeated if the same words also start earlier, in a
document with a smaller id or further up in the same one. Words that a repeated window covers are removed.

Anchors are shorter runs of words, hashed only at positions that are in a difference cover modulo a period. For any two
positions some shift of less than the period puts both on the cover, so two equal windows always share an anchor at the
same place inside them. Anchors that occur once rule out all windows around them; only windows that hold an anchor
found elsewhere are extended to their full length, hashed, and compared across the corpus.

Documents are worked on in chunks of neighbouring rows. A chunk sends each of its hashes once, however often it occurs
there, so a passage that a third of all rows share costs one row per chunk. Copies of whole texts are found first, by
the hash of the text, and send nothing.

Defined results: a null, empty or blank text has no words; texts shorter than a window lose nothing; a null id sorts
after all others; rows that repeat an id count as one document, whose windows at equal places are not earlier than each
other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import texts_of
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Difference covers by period. All differences modulo the period occur between two members.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
# An anchor has so many words at least, if the window allows it.
ANCHOR_WORDS = 8
# Neighbouring rows that are worked on together, and the bytes beyond which a text is worked on alone.
CHUNK_ROWS = 256
LONG_TEXT = 1 << 18
# Short chunk numbers, which the marks carry.
CHUNK_NUMBERS = 2**31
# Multipliers of two independent rolling hashes, odd 64-bit numbers.
FIRST, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
LAST_ID = 2**63 - 1


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """The longest period that leaves an anchor of enough words, its cover, and the anchor's words."""
    period = max(p for p in COVERS if p == 1 or window - p + 1 >= ANCHOR_WORDS)
    return period, COVERS[period], window - period + 1


def rolling(words: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """The polynomial hash of every run of ``length`` word hashes, by doubling the length of known runs."""

    def joined(left: np.ndarray, left_words: int, right: np.ndarray, right_words: int) -> np.ndarray:
        n = max(0, len(words) - left_words - right_words + 1)
        power = np.uint64(pow(multiplier, right_words, 2**64))
        return left[:n] * power + right[left_words : left_words + n]

    run, run_words, result, result_words = words, 1, None, 0
    while True:
        if length & run_words:
            result = run if result is None else joined(run, run_words, result, result_words)
            result_words += run_words
        if result_words == length:
            return result[: max(0, len(words) - length + 1)]
        run, run_words = joined(run, run_words, run, run_words), 2 * run_words


class Chunk:
    """The words of neighbouring documents in one row of hashes, and which runs of them lie in one document."""

    def __init__(self, table: pa.Table, window: int, copies: set[tuple[int, int]] = frozenset()):
        self.window = window
        self.rows = list(zip(table["row"].to_pylist(), table["whole"].to_pylist(), strict=True))
        self.ids = table["doc_id"].to_pylist()
        self.texts = texts_of(table["text"].combine_chunks())
        digest, hashes, size = xxhash.xxh3_64_intdigest, [], []
        for row, text in zip(self.rows, self.texts, strict=True):
            words = text.split()
            size.append(len(words))
            if len(words) >= window and row not in copies:
                hashes.append(np.fromiter(map(digest, words), dtype=np.uint64, count=len(words)))
        self.size = np.array(size, dtype=np.int64)
        self.copied = np.array([r in copies for r in self.rows], dtype=bool) & (self.size >= window)
        used = (self.size >= window) & ~self.copied
        self.hashes = np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)])
        size = self.size[used]
        self.doc = np.repeat(np.flatnonzero(used).astype(np.int32), size)
        self.start = np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        self.end = self.start + np.repeat(size.astype(np.int32), size)
        self.place = np.arange(len(self.hashes), dtype=np.int32) - self.start

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions on the cover with room for an anchor, and the anchors' hashes."""
        period, cover, words = cover_for(self.window)
        at = np.arange(max(0, len(self.hashes) - words + 1))
        at = at[(at + words <= self.end[at]) & np.isin(self.place[at] % period, cover)]
        return at, rolling(self.hashes, words, FIRST)[at]

    def candidates(self, elsewhere: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor found in another chunk or twice in this one."""
        at, anchor = self.anchors()
        _, inverse, count = np.unique(anchor, return_inverse=True, return_counts=True)
        at = at[(count[inverse] > 1) | np.isin(anchor, elsewhere)] if len(at) else at
        first = np.maximum(at - cover_for(self.window)[0] + 1, self.start[at])
        last = np.minimum(at, self.end[at] - self.window)
        change = np.zeros(len(self.hashes) + 1, dtype=np.int32)
        np.add.at(change, first[first <= last], 1)
        np.add.at(change, last[first <= last] + 1, -1)
        return np.flatnonzero(np.cumsum(change[:-1]) > 0)

    def order(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What decides which of two equal windows is earlier: id, then place."""
        ids = np.array([LAST_ID if i is None else i for i in self.ids], dtype=np.int64)
        return ids[self.doc[at]], self.place[at].astype(np.int64)

    def window_hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = rolling(self.hashes, self.window, SECOND)[at] >> np.uint64(32)
        return rolling(self.hashes, self.window, FIRST)[at].astype(np.int64), low.astype(np.int64)

    def firsts(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each distinct window among the starts, the earliest: hashes, id and place."""
        w1, w2 = self.window_hashes(at)
        ids, place = self.order(at)
        by = np.lexsort((place, ids, w2, w1))
        w1, w2, ids, place = w1[by], w2[by], ids[by], place[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        return w1[new], w2[new], ids[new], place[new]

    def repeated(self, later_w1: np.ndarray, later_w2: np.ndarray) -> np.ndarray:
        """Which words a repeated window covers: one repeated in this chunk, or one whose first occurrence here is
        not the first of the corpus."""
        at = np.arange(max(0, len(self.hashes) - self.window + 1))
        at = at[at + self.window <= self.end[at]]
        w1, w2 = self.window_hashes(at)
        ids, place = self.order(at)
        by = np.lexsort((place, ids, w2, w1))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (w1[by][1:] != w1[by][:-1]) | (w2[by][1:] != w2[by][:-1])
        head = by[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(by) else by
        again = np.zeros(len(at), dtype=bool)
        again[by] = (ids[by] != ids[head]) | (place[by] != place[head])
        pairs = np.stack([later_w1, later_w2], axis=1).astype(np.int64)
        mine = np.ascontiguousarray(np.stack([w1, w2], axis=1))
        as_pair = np.dtype([("a", np.int64), ("b", np.int64)])
        again |= np.isin(mine.view(as_pair).ravel(), np.ascontiguousarray(pairs).view(as_pair).ravel())
        change = np.zeros(len(self.hashes) + 1, dtype=np.int32)
        np.add.at(change, at[again], 1)
        np.add.at(change, at[again] + self.window, -1)
        return np.cumsum(change[:-1]) > 0


def chunked(docs: DataFrame, text: str) -> DataFrame:
    """Chunk, its whole number, row in its file, id and text of every document; tables that are not stored are stored first."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    try:
        own = F.col(text).cast("string")
        alone = F.when(F.octet_length(own) > LONG_TEXT, F.col("_metadata.row_index"))
        together = F.floor(F.col("_metadata.row_index") / CHUNK_ROWS)
        placed = docs.select(
            F.xxhash64("_metadata.file_path", together, alone).alias("whole"),
            F.col("_metadata.row_index").alias("row"),
            F.col("doc_id").cast("bigint"),
            own.alias("text"),
        )
    except AnalysisException:
        return chunked(stage(rows, "texts"), "text")
    # Chunks that share a short number are worked on together; their rows differ in the whole number.
    return placed.withColumn("chunk", F.pmod(F.col("whole"), F.lit(CHUNK_NUMBERS)).cast("int"))


def whole_copies(docs: DataFrame) -> DataFrame:
    """Rows whose whole text a smaller id has too."""
    order = F.coalesce("doc_id", F.lit(LAST_ID))
    keyed = docs.filter(F.length("text") > 0).select(
        "chunk", "row", "whole", order.alias("id"), *[F.xxhash64(F.lit(i), "text").alias(f"t{i}") for i in (0, 1)]
    )
    first = keyed.groupBy("t0", "t1").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = keyed.join(first, ["t0", "t1"]).filter(F.col("id") > F.col("first"))
    return copies.select("chunk", F.lit(0).alias("kind"), F.col("row").alias("a"), F.col("whole").alias("b"))


def _marks(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    mine = table.filter(pa.compute.equal(table["kind"], kind))
    return mine["a"].to_numpy(), mine["b"].to_numpy()


def remove_repeats(docs: DataFrame, window: int = 20, text: str = "text") -> DataFrame:
    """Id, words, removed words and the kept words, joined by one space, of every document."""
    rows = chunked(docs, text)
    copies = stage(whole_copies(rows), "copies")

    def together(marks: DataFrame):
        return rows.groupBy("chunk").cogroup(marks.groupBy("chunk"))

    def chunk_of(left: pa.Table, right: pa.Table) -> Chunk:
        row, whole = _marks(right, 0)
        return Chunk(left, window, set(zip(row.tolist(), whole.tolist(), strict=True)))

    def send_anchors(left: pa.Table, right: pa.Table) -> pa.Table:
        number = left["chunk"][0].as_py() if left.num_rows else 0
        found = np.unique(chunk_of(left, right).anchors()[1]).astype(np.int64)
        return pa.table({"chunk": pa.array(np.full(len(found), number, dtype=np.int32)), "a": pa.array(found)})

    anchors = together(copies).applyInArrow(send_anchors, "chunk int, a long")
    holders = Window.partitionBy("a")
    elsewhere = (
        anchors.withColumn("holders", F.count("*").over(holders))
        .filter(F.col("holders") > 1)
        .select("chunk", F.lit(1).alias("kind"), "a", F.lit(0).cast("bigint").alias("b"))
    )

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        number = left["chunk"][0].as_py() if left.num_rows else 0
        chunk = chunk_of(left, right)
        w1, w2, ids, place = chunk.firsts(chunk.candidates(_marks(right, 1)[0].astype(np.uint64)))
        # Values that neighbouring rows share come first: the shuffle then compresses them away.
        return pa.table(
            {
                "id": pa.array(ids),
                "chunk": pa.array(np.full(len(ids), number, dtype=np.int32)),
                "w1": pa.array(w1),
                "w2_place": pa.array((w2 << 32) | place),
            }
        )

    windows = together(copies.unionByName(elsewhere)).applyInArrow(
        send_windows, "id long, chunk int, w1 long, w2_place long"
    )
    w2 = F.shiftrightunsigned("w2_place", 32)
    earlier = Window.partitionBy("w1", "w2").orderBy("id", "w2_place")
    later = (
        windows.repartition("w1")
        .withColumn("w2", w2)
        .withColumn("rank", F.rank().over(earlier))
        .filter(F.col("rank") > 1)
        .select("chunk", F.lit(2).alias("kind"), F.col("w1").alias("a"), F.col("w2").alias("b"))
    )

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = chunk_of(left, right)
        gone = chunk.repeated(*_marks(right, 2))
        starts = np.searchsorted(chunk.doc, np.arange(len(chunk.rows)))
        kept, removed = [], []
        for i, text_ in enumerate(chunk.texts):
            words = text_.split()
            if chunk.copied[i]:
                stay = []
            else:
                mine = gone[starts[i] : starts[i] + len(words)] if len(words) >= window else np.zeros(0, dtype=bool)
                stay = [w for w, g in zip(words, mine.tolist(), strict=True) if not g] if mine.any() else words
            kept.append(b" ".join(stay).decode())
            removed.append(len(words) - len(stay))
        return pa.table(
            {
                "doc_id": pa.array(chunk.ids, pa.int64()),
                "n_words": pa.array(chunk.size),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return together(copies.unionByName(later)).applyInArrow(keep, schema)
