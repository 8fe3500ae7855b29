"""Conversations of typed content parts as training text, with attachments, loss mask and expanded token counts.

A turn's content is a list of parts: text, image, audio, document. A visitor goes over them in order; text is escaped
and copied, every attachment becomes the placeholder of its kind, and its reference, place and number of tokens are
recorded, so that the n-th placeholder of a turn belongs to the n-th record. A plain string is read as parts too: the
notation ``![caption](reference)`` is an attachment if the reference has the ending of an image, sound or document,
everything else is text.

The template marks turns with control strings. Inside texts and roles a backslash is doubled and a control string gets
one after its first character, so that no text can pass for a mark and every text can be read back.

Turns are formatted where they are: a conversation's text is the concatenation of its turns' texts, whatever their
number. ``read_back`` reads conversations from those texts in one sorted pass that keeps one turn at a time, so a
conversation of any length needs little memory.

Defined results: a null text, role or list of parts is empty; a null kind or a kind without a placeholder is text; a
null turn number comes first, and turns of equal number follow in the order of their formatted texts; rows that repeat
are turns of their own; rows without an id are one conversation; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.packing import WordEncoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The template: marks of the user's turn, of other roles' names, of the end of the other turns, of attachments.
USER, USER_END = "[INST]", "[/INST]"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
END = "</s>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
CONTROL = [USER, USER_END, ROLE, ROLE_END, END, *PLACEHOLDERS.values()]
# The endings of references by kind of attachment, and the notation of an attachment in a string.
ENDINGS = {"image": "png|jpe?g|gif|webp", "audio": "mp3|wav|flac|ogg", "document": "pdf|docx?|txt|csv"}
NOTATION = r"!\[([^\]\n]*)\]\(([^)\s]+\.(?:" + "|".join(ENDINGS.values()) + r"))\)"
# Tokens of attachments: per square of so many pixels, per second, per page; and the size of one whose size is unknown.
PATCH_PIXELS, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 12.5, 512
UNKNOWN = {"width": 448, "height": 448, "seconds": 30, "pages": 1}

ATTACHMENT = "struct<part: int, kind: string, ref: string, caption: string, at: long, tokens: long>"
TURNS = (
    "conv_id long, turn long, formatted string, loss_start long, loss_end long, "
    f"attachments array<{ATTACHMENT}>, tokens long"
)
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_control = re.compile("|".join(map(re.escape, CONTROL)))
_marks = re.compile("(" + "|".join(map(re.escape, CONTROL)) + ")")
_notation = re.compile(NOTATION)
_kinds = {kind: re.compile(rf"\.(?:{endings})$") for kind, endings in ENDINGS.items()}


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parts_of(text: str) -> Iterator[dict]:
    """The typed parts of a plain string."""
    at = 0
    for found in _notation.finditer(text) if "![" in text else ():
        kind = next(k for k, ending in _kinds.items() if ending.search(found[2]))
        yield {"kind": "text", "text": text[at : found.start()]}
        yield {"kind": kind, "text": found[1], "ref": found[2]}
        at = found.end()
    yield {"kind": "text", "text": text[at:]}


def notation(caption: str | None, ref: str | None) -> str:
    return f"![{caption or ''}]({ref or ''})"


class Flattener:
    """Visits the parts of one turn's content in order."""

    def __init__(self, count: Callable[[str], int]):
        self.count = count
        self.visits = {"image": self.image, "audio": self.audio, "document": self.document}
        self.pieces: list[str] = []
        self.attachments: list[dict] = []
        self.chars = self.tokens = self.seen = 0

    def visit(self, part: dict) -> None:
        self.visits.get(part.get("kind"), self.text)(part)
        self.seen += 1

    def text(self, part: dict) -> None:
        held = part.get("text") or ""
        self._add(escape(held), self.count(held) if held else 0)

    def image(self, part: dict) -> None:
        width, height = self._size(part, "width"), self._size(part, "height")
        self._attach(part, math.ceil(width / PATCH_PIXELS) * math.ceil(height / PATCH_PIXELS))

    def audio(self, part: dict) -> None:
        self._attach(part, math.ceil(self._size(part, "seconds") * TOKENS_PER_SECOND))

    def document(self, part: dict) -> None:
        self._attach(part, self._size(part, "pages") * TOKENS_PER_PAGE)

    def _size(self, part: dict, name: str) -> float:
        value = part.get(name)
        return UNKNOWN[name] if value is None or not math.isfinite(value) or value < 0 else value

    def _attach(self, part: dict, tokens: float) -> None:
        kind, tokens = part["kind"], int(tokens)
        record = {"part": self.seen, "kind": kind, "ref": part.get("ref"), "caption": part.get("text")}
        self.attachments.append(record | {"at": self.chars, "tokens": tokens})
        self._add(PLACEHOLDERS[kind], tokens)

    def _add(self, piece: str, tokens: int) -> None:
        self.pieces.append(piece)
        self.chars += len(piece)
        self.tokens += tokens


def format_turn(role: str, parts: Iterator[dict], count: Callable[[str], int]) -> dict:
    """A turn's text, the stretch of it that is under the loss, its attachments and tokens without the marks."""
    flat = Flattener(count)
    for part in parts:
        flat.visit(part)
    content = "".join(flat.pieces)
    before, after = {"user": (USER, USER_END), "assistant": ("", END)}.get(role) or (ROLE + escape(role) + ROLE_END, END)
    learnt = role == "assistant"
    return {
        "formatted": before + content + after,
        "loss_start": len(before) if learnt else None,
        "loss_end": len(before) + len(content) if learnt else None,
        "attachments": [a | {"at": a["at"] + len(before)} for a in flat.attachments],
        "tokens": flat.tokens,
    }


def format_turns(turns: DataFrame, content: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One formatted row per turn of (conv_id, turn, role, content).

    The content is a string, or a list of structs with a ``kind`` and, as far as known, ``text`` (a text, or an
    attachment's caption), ``ref``, ``width``, ``height``, ``seconds`` and ``pages``. Texts count as tokens only with
    a tokenizer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer) if tokenizer else None
        schema = pa.schema(
            [("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64())]
            + [("loss_end", pa.int64()), ("attachments", pa.list_(attachment)), ("tokens", pa.int64())]
        )

        def count(text: str) -> int:
            return len(next(encoder.encode(pa.array([text])))) if encoder else 0

        for batch in batches:
            rows = []
            for conv, turn, role, held in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                parts = parts_of(held or "") if held is None or isinstance(held, str) else (p for p in held if p)
                rows.append({"conv_id": conv, "turn": turn} | format_turn(role or "", parts, count))
            yield pa.RecordBatch.from_pylist(rows, schema)

    attachment = pa.struct(
        [("part", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("caption", pa.string())]
        + [("at", pa.int64()), ("tokens", pa.int64())]
    )
    return turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col(f"`{content}`")
    ).mapInArrow(run, TURNS)


def in_order(formatted: DataFrame) -> DataFrame:
    """The turns of each conversation together and in order: by number, nulls first, then by text."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("formatted")]
    return formatted.repartition("conv_id").sortWithinPartitions(*order)


def assemble(formatted: DataFrame) -> DataFrame:
    """One row per conversation: its text, loss spans, attachments and tokens, with places in that text.

    A conversation must fit in one row; ``read_back`` and trainers that stream turns have no such limit.
    """
    turn = F.struct("turn", "formatted", "loss_start", "loss_end", "attachments", "tokens")
    together = formatted.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    place = "struct<at: bigint, turns: array<struct<before: bigint, loss_start: bigint, loss_end: bigint>>>"
    first = F.from_json(F.lit('{"at": 0, "turns": []}'), place)
    placed = F.aggregate(
        "turns",
        first,
        lambda done, t: F.struct(
            (done["at"] + F.length(t["formatted"])).alias("at"),
            F.concat(
                done["turns"],
                F.array(
                    F.struct(
                        done["at"].cast("bigint").alias("before"),
                        (done["at"] + t["loss_start"]).alias("loss_start"),
                        (done["at"] + t["loss_end"]).alias("loss_end"),
                    )
                ),
            ).alias("turns"),
        ),
    )["turns"]
    with_places = together.withColumn("places", placed)
    shown = F.flatten(
        F.transform(
            F.arrays_zip("turns", "places"),
            lambda z: F.transform(
                z["turns"]["attachments"], lambda a: a.withField("at", a["at"] + z["places"]["before"])
            ),
        )
    )
    spans = F.filter("places", lambda p: p["loss_start"].isNotNull())
    return with_places.select(
        "conv_id",
        F.concat_ws("", F.transform("turns", lambda t: t["formatted"])).alias("formatted"),
        F.transform(spans, lambda p: F.struct(p["loss_start"].alias("start"), p["loss_end"].alias("end"))).alias("loss"),
        shown.alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda s, t: s + t["tokens"]).alias("tokens"),
    )


def read_text(formatted: str, attachments: Iterator[dict]) -> str:
    """A text as it was before it was formatted, with its attachments in their notation."""
    found = []
    for piece in _marks.split(formatted):
        if piece in PLACEHOLDERS.values():
            record = next(attachments)
            found.append(notation(record["caption"], record["ref"]))
        else:
            found.append(unescape(piece))
    return "".join(found)


def read_turns(formatted: str, attachments: list[dict]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a formatted text, found by the marks alone."""
    left = iter(attachments)
    pieces = _marks.split(formatted)
    i = 0
    while i < len(pieces) - 1:
        role, closing = "assistant", END
        if not pieces[i] and pieces[i + 1] == USER:
            role, closing, i = "user", USER_END, i + 2
        elif not pieces[i] and pieces[i + 1] == ROLE:
            role, i = unescape(pieces[i + 2]), i + 4
        end = pieces.index(closing, i)
        yield role, read_text("".join(pieces[i:end]), left)
        i = end + 1


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and their digest, learnt text and its digest, and length of every conversation, read from the texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv) -> dict:
            return {
                "conv_id": conv,
                "n_turns": n_turns,
                "turns_sha256": turns.hexdigest(),
                "loss_chars": loss_chars,
                "loss_sha256": learnt.hexdigest(),
                "formatted_chars": chars,
            }

        schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in map(str.split, READ.split(", "))])
        now: tuple = ()
        for batch in batches:
            done = []
            for conv, text, start, end, records in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now != (conv,):
                    if now:
                        done.append(row(*now))
                    now, n_turns, chars, loss_chars = (conv,), 0, 0, 0
                    turns, learnt = hashlib.sha256(), hashlib.sha256()
                for role, held in read_turns(text, records):
                    n_turns += 1
                    turns.update(f"{role}\n{held}\n".encode())
                if start is not None:
                    held = read_text(text[start:end], iter(records))
                    learnt.update(held.encode())
                    loss_chars += len(held)
                chars += len(text)
            yield pa.RecordBatch.from_pylist(done, schema)
        if now:
            yield pa.RecordBatch.from_pylist([row(*now)], schema)

    return (
        in_order(formatted)
        .select("conv_id", "formatted", "loss_start", "loss_end", "attachments")
        .mapInArrow(read, READ)
    )
