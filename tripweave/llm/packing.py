"""Best-fit packing of tokenised documents into sequences by the sum-of-squares rule.

A document becomes its token ids and one end id. Only documents longer than a sequence are cut. Every piece is
placed where the sum over all residual gaps of (open bins with that gap) squared becomes smallest; a new bin is one
of the choices only if no open bin has room, since the aim is the fewest sequences. Ties go to the smallest gap.

The pieces are dealt at random into groups of a fixed number of tokens. A group is packed in one task, longest piece
first, and holds some thousand sequences. The sequences a group leaves open are few; those of many groups are taken
apart and packed once more together.

Defined results: a null or empty text is one piece holding the end id; a null or repeated id is packed like any
other, row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tokens packed in one task, and groups whose open sequences are packed again together.
GROUP_TOKENS = 16_000_000
GROUPS_TOGETHER = 64
# Bytes of text whose words are numbered together, and texts whose ids are put together at once.
TEXT_AT_ONCE = 16 << 20
ROWS_AT_ONCE = 1000
# The punctuation of ASCII.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "sequence_id long, offset long"


def _list(array: pa.Array) -> list:
    return array.to_numpy(zero_copy_only=False).tolist()


def _gather(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``ids``, one after the other, and where each of them ends."""
    ends = np.cumsum(size, dtype=np.int64)
    used = np.flatnonzero(size)
    step = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
    step[ends[used] - size[used]] = first[used]
    step[ends[used[:-1]]] -= first[used[:-1]] + size[used[:-1]] - 1
    return ids[np.cumsum(step, dtype=np.int32)], ends


class WordEncoder:
    """Token ids of texts, each different word of which is encoded once.

    For vocabularies that drop white space, fold case and mark the end of a word: no token then spans two words, so the
    ids of a text are those of its words, and the ids of words of letters can be told apart by their ends. Arrow splits
    and numbers the words. Only white space, letters and punctuation of ASCII are handled here; all else is the
    tokenizer's.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith("</w>")

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text. All texts are split together, their ids put together some at a time."""
        texts = texts.cast(pa.string()).fill_null("")
        special = pa.compute.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pa.compute.if_else(pa.array(special), "", texts)
        split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(plain))
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        numbered = split.flatten().dictionary_encode()
        ids, first, size = self._words(numbered.dictionary)
        word = numbered.indices.to_numpy()
        for a in range(0, len(texts), ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, len(texts))
            here = word[bounds[a] : bounds[b]]
            found, ends = _gather(ids, first[here], size[here])
            cuts = np.concatenate([[0], ends])[bounds[a : b + 1] - bounds[a]].tolist()
            for i in range(a, b):
                if special[i]:
                    yield np.array(self._ids([texts[i].as_py()])[0], dtype="<u4")
                else:
                    yield found[cuts[i - a] : cuts[i - a + 1]]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each word begin and how many they are.

        Closing punctuation after a letter or digit is a unit of its own, so many words share their stem.
        """
        stems = pa.compute.utf8_rtrim(words, PUNCTUATION)
        cut = pa.compute.and_(pa.compute.not_equal(words, stems), pa.compute.match_substring_regex(stems, "[0-9a-z]$"))
        length = pa.compute.binary_length(stems.filter(cut)).to_pylist()
        closing = [w[n:] for w, n in zip(_list(words.filter(cut).cast(pa.binary())), length, strict=True)]
        stems = pa.compute.if_else(cut, stems, words)
        units = pa.concat_arrays([stems, pa.array(closing, pa.binary()).cast(pa.string())]).dictionary_encode()
        ids, first, size = self._units(units.dictionary)
        unit = units.indices.to_numpy()
        whole, closed = unit[: len(words)], np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        both = np.stack([whole[closed], unit[len(words) :]], axis=1).ravel()
        more, ends = _gather(ids, first[both], size[both])
        word_first, word_size = first[whole], size[whole]
        word_size[closed] += size[unit[len(words) :]]
        word_first[closed] = len(ids) + ends[1::2] - word_size[closed]
        return np.concatenate([ids, more]), word_first, word_size

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of letters only end with the only word-end token they have, so many go in one call."""
        letters = pa.compute.utf8_is_alpha(units).to_numpy(zero_copy_only=False)
        text = _list(units)
        plain, other = np.flatnonzero(letters), np.flatnonzero(~letters).tolist()
        size = np.zeros(len(units), dtype=np.int32)
        first = np.zeros(len(units), dtype=np.int32)
        found, at = [np.zeros(0, dtype="<u4")], 0
        for start in range(0, len(plain), 4096):
            part = plain[start : start + 4096]
            ids = np.array(self._ids([" ".join([text[i] for i in part])])[0], dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                other += part.tolist()
                continue
            size[part] = np.diff(ends, prepend=0)
            first[part] = at + ends - size[part]
            found.append(ids)
            at += len(ids)
        for i, ids in zip(other, self._ids([text[i] for i in other]), strict=True):
            size[i], first[i] = len(ids), at
            found.append(np.array(ids, dtype="<u4"))
            at += len(ids)
        return np.concatenate(found), first, size

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``TEXT_AT_ONCE`` bytes of text."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(size, dtype=np.int64) // TEXT_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def tokenize(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 1, text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, with the checksum of the ids and, if asked for, the ids."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, 1):
                doc, piece, start, length, crc, raw = [], [], [], [], [], []
                for n, found in zip(batch[0].to_pylist(), encoder.encode(batch[1]), strict=True):
                    ids = found.tobytes() + end
                    for i, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a : a + 4 * capacity]
                        doc.append(n)
                        piece.append(i)
                        start.append(a // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        raw.append(part)
                columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32())]
                columns += [pa.array(c, pa.int64()) for c in (start, length, crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(pieces, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order, and the gap each bin is left with."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap; a full bin is not open
    bins_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    where = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    for i, size in enumerate(lengths.tolist()):
        before = count[size:]
        # Moving a bin from gap g to g - size changes the sum of squares by 2 (N[g - size] - N[g] + 1), closing it
        # by 1 - 2 N[size].
        change = np.where(before > 0, 2 * (count[: capacity + 1 - size] - before + 1), 4 * len(lengths) + 4)
        change[0] = 1 - 2 * before[0] if before[0] else change[0]
        best = int(change.argmin())
        gap = size + best
        if before[best]:
            number = bins_at[gap].pop()
            count[gap] -= 1
        else:
            number, gap = len(gap_of), capacity
            gap_of.append(gap)
        where[i], offset[i] = number, capacity - gap
        gap -= size
        gap_of[number] = gap
        if gap:
            count[gap] += 1
            bins_at[gap].append(number)
    return where, offset, np.array(gap_of, dtype=np.int64)


def _pack_groups(pieces: DataFrame, n_groups: int, capacity: int, base: int) -> DataFrame:
    """Every group of pieces packed by itself; ``gap`` is what the sequence of a piece is left with."""

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_row"], ascending=[False, True])
        where, offset, gap = place(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=base + key[0] * 2**32 + where, offset=offset, _gap=gap[where])

    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(n_groups)))
    schema = ", ".join(f"`{c}` {t}" for c, t in grouped.dtypes) + f", {PACKED}, _gap long"
    return grouped.groupBy("_group").applyInPandas(pack, schema).drop("_group")


def pack(pieces: DataFrame, capacity: int, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``."""
    columns = pieces.columns
    pieces = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    tokens = pieces.filter(~full).agg(F.sum("length")).first()[0] or 0
    n_groups = max(1, -(-tokens // group_tokens))
    first = stage(_pack_groups(pieces.filter(~full), n_groups, capacity, 0), "packed")
    alone = pieces.filter(full).withColumns({"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("bigint")})
    done = first
    if n_groups > 1:
        # A sequence left open by more than a hundredth goes into the second round.
        loose = F.col("_gap") > capacity // 100
        done = first.filter(~loose).unionByName(
            _pack_groups(
                first.filter(loose).drop("sequence_id", "offset", "_gap"),
                -(-n_groups // GROUPS_TOGETHER),
                capacity,
                2**62,
            )
        )
    return done.select(*columns, "sequence_id", "offset").unionByName(alone.select(*columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text"):
    """Pieces of all documents with their place in a sequence."""
    return pack(tokenize(docs, tokenizer, capacity, end_id, text), capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces with ids: a sequence's token ids in order."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.concat_ws("", F.transform(inside, lambda p: F.hex(p["ids"]))).alias("_hex")
    ).select("sequence_id", "length", F.unhex("_hex").alias("ids"))
