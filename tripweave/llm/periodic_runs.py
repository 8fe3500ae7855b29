"""Periodic runs of words, found with string synchronising sets and collapsed to one period.

A run is a stretch of consecutive words with smallest period q, at least ``powers`` periods long, that no neighbouring
word extends. Collapsing drops every word that some run contains after that run's first q words.

Positions are selected by the hash of their context, so that equal contexts select equally: at scale t, position i is
in the set if the smallest hash among the windows of t words that start at i .. i + t is that of the first or the last
of them. Of the positions in the set, neighbours whose contexts of 2 t words are equal propose their distance as a
period, from t up to below 2 t; scales double from ``FIRST_SCALE`` on. Every proposal is compared word by word and
extended as far as the period holds, so hashes decide nothing but where to look.

Windows inside regions of a period of at most a quarter of the scale are left out of the set, which would otherwise hold
nearly all of their positions. Those regions are found separately: periods below the first scale by comparing each word
with the one so many places on, longer ones as the runs of the scales before. A window of t words with a period of at
most t / 4 is part of a run of at least four periods, so the regions are known when a scale needs them; and a run whose
period is at least t has no such stretch of 3 t words, so that each run of at least four periods holds a selected
position and the next one, one period on.

Documents of a slice of text are worked on as one row of word numbers, with a number of its own after each document,
which no run can cross. A task needs about a hundred bytes for every word of a slice, or of a document that is longer.

Defined results: a null, empty or blank text has no words and no runs; a null id is passed on; repeated rows are
documents of their own; a run that ends where the text ends is a run; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import text_slices, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are worked on as one row of words.
TEXT_AT_ONCE = 2 << 20
# The shortest context of a synchronising set; smaller periods are found by comparing neighbours.
FIRST_SCALE = 4
# A window is highly periodic if it holds its period so many times; runs of so many periods are surely found.
POWERS = 4
# Odd 64-bit numbers that mix hashes.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)
NOT_SELECTED = np.uint64(2**64 - 1)

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"


def mixed(values: np.ndarray) -> np.ndarray:
    """Different numbers for different numbers, without their order."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def doubled(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the windows twice as long; those that run past the end keep what there is of them."""
    after = np.zeros_like(hashes)
    after[: max(0, len(hashes) - words)] = hashes[words:]
    return mixed(hashes * np.uint64(MIX[2]) + after)


def sliding_minimum(values: np.ndarray, length: int) -> np.ndarray:
    """The smallest of ``length + 1`` values from each position on, for a power of two."""
    least, reach = values, 1
    while reach < length:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(values) - length], values[length:])


def synchronising_set(hashes: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Selected positions, of those whose context of two windows lies inside."""
    key = np.where(periodic, NOT_SELECTED, hashes)
    least = sliding_minimum(key, scale)
    chosen = (key[: len(least)] == least) | (key[scale:] == least)
    return np.flatnonzero(chosen & (least != NOT_SELECTED))


def matching(words: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """The stretch around a position in which words one period apart are equal: its first word and its end."""
    low, high, step = start, start, max(64, 4 * period)
    while high < len(words) - period:
        upto = min(high + step, len(words) - period)
        differ = words[high:upto] != words[high + period : upto + period]
        if differ.any():
            high += int(differ.argmax())
            break
        high, step = upto, 2 * step
    step = max(64, 4 * period)
    while low > 0:
        down = max(0, low - step)
        differ = words[down:low] != words[down + period : low + period]
        if differ.any():
            low -= int(differ[::-1].argmax())
            break
        low, step = down, 2 * step
    return low, high + period


def divisors(period: int) -> list[int]:
    """The period divided by each of its prime factors."""
    found, rest, factor = [], period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            found.append(period // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return found + ([period // rest] if rest > 1 else [])


def is_smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of several periods has no smaller one, which would divide it."""
    return not any(
        np.array_equal(words[start : start + period], words[start + part : start + part + period])
        for part in divisors(period)
    )


def short_runs(words: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """Runs of a small period, from where each word equals the one so many places on."""
    equal = np.zeros(max(0, len(words) - period) + 2, dtype=np.int8)
    equal[1:-1] = words[: max(0, len(words) - period)] == words[period:]
    change = np.diff(equal)
    first, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    enough = end - first >= (POWERS - 1) * period
    found = zip(first[enough].tolist(), end[enough].tolist(), strict=True)
    return [(s, e - s + period, period) for s, e in found if is_smallest(words, s, period)]


def proposals(selected: np.ndarray, contexts: np.ndarray, scale: int) -> list[tuple[int, int]]:
    """(period, position) of neighbours in the set with equal contexts, sorted."""
    order = np.argsort(contexts[selected], kind="stable")
    at, context = selected[order], contexts[selected][order]
    apart = np.diff(at)
    pair = np.flatnonzero((context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale))
    return sorted(zip(apart[pair].tolist(), at[pair].tolist(), strict=True))


def all_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of at least four periods, in a row of word numbers of which no
    more than ``longest`` belong to one document."""
    found = [run for period in range(1, min(FIRST_SCALE, longest)) for run in short_runs(words, period)]
    hashes = mixed(words.astype(np.uint64))
    scale = 1
    while POWERS * scale <= longest:
        contexts = doubled(hashes, scale)
        if scale >= FIRST_SCALE:
            change = np.zeros(len(words) + 1, dtype=np.int32)
            regions = [(s, n) for s, n, period in found if POWERS * period <= scale <= n]
            if regions:
                inside = np.array(regions, dtype=np.int64)
                np.add.at(change, inside[:, 0], 1)
                np.add.at(change, inside[:, 0] + inside[:, 1] - scale + 1, -1)
            selected = synchronising_set(hashes, scale, np.cumsum(change[:-1]) > 0)
            last = (0, 0, 0)
            for period, at in proposals(selected, contexts, scale):
                if period == last[0] and last[1] <= at and at + period + 2 * scale <= last[2]:
                    continue
                first, end = matching(words, at, period)
                last = (period, first, end)
                if end - first >= POWERS * period and is_smallest(words, first, period):
                    found.append((first, end - first, period))
        hashes, scale = contexts, 2 * scale
    return sorted(set(found))


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of word numbers with a number of its own after each text; where each text begins, and its words."""
    split = pa.compute.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pa.compute.index(coded.dictionary, "").as_py()  # white space at either end leaves an empty word
    real = word != empty
    upto = np.concatenate([[0], np.cumsum(real)])[bounds]
    size = np.diff(upto)
    row = np.empty(len(texts) + int(upto[-1]), dtype=np.int64)
    ends = upto[1:] + np.arange(len(texts))
    at = np.ones(len(row), dtype=bool)
    at[ends] = False
    row[at] = word[real]
    row[ends] = len(coded.dictionary) + np.arange(len(texts))
    return row, ends - size, size


def document_runs(
    texts: pa.Array, powers: int, min_words: int
) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Of each text: how many words it has, its runs, and the words that stay."""
    row, starts, sizes = numbered(texts)
    found = [
        r for r in all_runs(row, int(sizes.max(initial=0))) if r[1] >= max(min_words, powers * r[2])
    ]
    owner = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    mine: dict[int, list[tuple[int, int, int]]] = {}
    for (first, length, period), i in zip(found, owner.tolist(), strict=True):
        mine.setdefault(i, []).append((first - int(starts[i]), length, period))
    for i, text in enumerate(texts_of(texts)):
        held, runs = text.split(), mine.get(i, [])
        if runs:
            change = np.zeros(len(held) + 1, dtype=np.int32)
            for first, length, period in runs:
                change[first + period] += 1
                change[first + length] -= 1
            held = [w for w, n in zip(held, np.cumsum(change[:-1]).tolist(), strict=True) if not n]
        yield int(sizes[i]), runs, b" ".join(held)


def collapse_runs(docs: DataFrame, powers: int = POWERS, min_words: int = 6, text: str = "text") -> DataFrame:
    """Id, words, runs in order of start and period, and the words outside repeated periods, joined by one space.

    ``powers`` is how many periods a run has at least, from four on.
    """
    if powers < POWERS:
        raise ValueError(f"runs of fewer than {POWERS} periods are not surely found")

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([pa.field(name, pa.int64()) for name in ("start", "length", "period")])
        for whole in batches:
            for batch in text_slices(whole, 1, TEXT_AT_ONCE):
                texts = batch[1].cast(pa.string()).fill_null("")
                n_words, runs, kept = zip(*document_runs(texts, powers, min_words), strict=True)
                flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
                offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run))
                columns = [batch[0], pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), fields)]
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "kept"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(collapse, SCHEMA)
