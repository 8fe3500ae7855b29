"""SimHash near-duplicates: deletion-variant signatures of half fingerprints.

Two fingerprints at most three bits apart have a half that differs in at most one bit. The index therefore holds,
for either half, the 32 variants that leave out one bit. Fingerprints that meet under an equal variant are verified
by their bit distance. Only distinct fingerprints enter the index, so copies cost one row each.

A bucket of equal variants gives no pairs but a forest: its fingerprints are walked breadth first over verified links,
each compared only with those not reached yet, and a link is written for each newly reached one. No two fingerprints
that are linked end up in different trees, and no link crosses two documents that the rule does not link. Large buckets
are cut by the bytes of the other half: linked fingerprints agree in at least one of its four bytes.

Defined results: a null, empty or blank text has fingerprint zero; a null id takes part, but is the smallest of its
group only if all are null; repeated rows each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import ROW_KEY, column, row_key, texts_of
from tripweave.llm.components import components
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The seed of the shingle hash, fingerprint bits and the halves they are cut into.
SEED = 42
HALVES, HALF_BITS = 2, 32
# Halves serve up to this distance: one of two then differs by at most one bit.
FARTHEST = 3

# Shingles whose bits are counted together, and the bucket size from which a bucket is cut further.
COUNTED_TOGETHER = 1 << 16
LARGE_BUCKET = 4096


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is one if it is set in over half of the hashes of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    n = len(words) - width + 1
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, COUNTED_TOGETHER):
        spans = zip(starts[at : at + COUNTED_TOGETHER], stops[at : at + COUNTED_TOGETHER], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """Row key, id and fingerprint of every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t, shingle) for t in texts_of(batch[3])]
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], batch[2], pa.array(bits, pa.int64())], [*ROW_KEY, "doc_id", "fingerprint"]
            )

    return docs.select(*row_key(docs), F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(
        compute, "_k1 long, _k2 long, doc_id long, fingerprint long"
    )


def variants(prints: DataFrame) -> DataFrame:
    """Every half of a fingerprint without each one of its bits, as (variant, fingerprint)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = np.arange(HALF_BITS, dtype=np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                bits = whole[0].slice(at, 4096).to_numpy().astype(np.uint64)
                keys = []
                for half in range(HALVES):
                    part = ((bits >> np.uint64(HALF_BITS * half)) & np.uint64(2**HALF_BITS - 1))[:, None]
                    without = (part & below) | ((part >> np.uint64(1)) & ~below)
                    keys.append(np.uint64(half << 36) | (bit << np.uint64(31)) | without)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys, axis=1).ravel().astype(np.int64)),
                        pa.array(np.repeat(bits.astype(np.int64), HALVES * HALF_BITS)),
                    ],
                    ["variant", "fingerprint"],
                )

    return prints.select("fingerprint").mapInArrow(cut, "variant long, fingerprint long")


def forest(bits: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by links of at most ``distance`` bits."""
    links, left = [], bits
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            here = reached.pop()
            near = np.bitwise_count(left ^ here) <= distance
            if near.any():
                links += [(here, other) for other in left[near]]
                reached += list(left[near])
                left = left[~near]
    return links


def bucket_links(bits: np.ndarray, half: int, distance: int) -> list[tuple[int, int]]:
    if len(bits) <= LARGE_BUCKET:
        return forest(bits, distance)
    links = []
    for byte in range(4):
        value = (bits >> np.uint64(HALF_BITS * (1 - half) + 8 * byte)) & np.uint64(255)
        for v in np.unique(value):
            links += forest(bits[value == v], distance)
    return links


def links(index: DataFrame, distance: int) -> DataFrame:
    """Verified links within the buckets of equal variants, as (a, b), enough to connect all that are linked."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(starts, len(key)))
            pair = starts[size == 2]
            close = np.bitwise_count(bits[pair] ^ bits[pair + 1]) <= distance
            out = [np.stack([bits[pair[close]], bits[pair[close] + 1]], axis=1)]
            for at, n in zip(starts[size > 2], size[size > 2], strict=True):
                some = bucket_links(bits[at : at + n], int(key[at] >> 36), distance)
                out.append(np.array(some, dtype=np.uint64).reshape(-1, 2))
            both = np.unique(np.concatenate(out), axis=0).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        held_key, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        for batch in batches:
            key = np.concatenate([held_key, batch[0].to_numpy()])
            bits = np.concatenate([held, batch[1].to_numpy().astype(np.uint64)])
            if len(key):
                last = np.searchsorted(key, key[-1])  # its bucket may go on in the next batch
                held_key, held = key[last:], bits[last:]
                if last:
                    yield found(key[:last], bits[:last])
        if len(held_key):
            yield found(held_key, held)

    return index.repartition("variant").sortWithinPartitions("variant", "fingerprint").mapInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, text: str = "text") -> DataFrame:
    """Row key, id, fingerprint, component and ``component_id``, the smallest id that links of at most ``distance``
    bits reach. ``component`` is the component's smallest fingerprint."""
    if not 0 <= distance <= FARTHEST:
        raise ValueError(f"halves with one wildcard serve distances up to {FARTHEST}")
    prints = stage(fingerprints(docs, shingle, text), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    member = components(links(variants(distinct), distance)).withColumnRenamed("node", "fingerprint")
    grouped = distinct.join(member, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    grouped = stage(grouped, "grouped")
    least = stage(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    named = stage(grouped.join(least, "component").select("fingerprint", "component", "component_id"), "components")
    return prints.join(named, "fingerprint")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id; of several such rows, one."""
    found = near_duplicates(docs, shingle, distance, text)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW_KEY))
    chosen = found.groupBy("component").agg(first.alias("_first")).select("_first.*").select(*ROW_KEY)
    keyed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("_doc"), *row_key(docs))
    return keyed.join(chosen, ROW_KEY, "left_semi").dropDuplicates(ROW_KEY).select("_doc.*")
