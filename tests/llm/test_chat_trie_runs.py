"""Chat formatting, the prefix trie and periodic runs: contracts over odd rows, and what the operators give besides."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripweave.llm import chat_format, periodic_runs, prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string"


def odd_conversations():
    rng = random.Random(4)
    odd = ["", "\\", "\\\\</s>", "[INST]", "<\\/s>", "[/INST][ROLE]x[/ROLE]", "![a](b.png) and ![](c/d.pdf)", "![x](y)", "é😀\n"]
    odd += ["[IMG]![see](s.wav)[IMG]", "[", "<", "</s", "a" * 30_000]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "assistant", "system", "[ROLE]", None, ""])
            rows.append((c, t, role, rng.choice([None, *odd, "hello", "yes", "no"])))
    # Copies, a common opening, turns without number, a repeated row, a conversation without id, a long one.
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]
    rows += [(c, t, "user", "same" if t < 2 else f"other {c}") for c in range(160, 200) for t in range(4)]
    rows += [(300, None, "user", "first"), (300, 0, "user", "then"), (301, 0, "user", "twice"), (301, 0, "user", "twice")]
    rows += [(None, 0, "assistant", "no id"), (None, 1, None, None), (-3, 0, "user", "below zero")]
    rows += [(c, t, "user", f"turn {t}") for c in (400, 401, 402) for t in range(500)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd-conversations")
    frame = spark.createDataFrame(odd_conversations(), TURNS)
    for name in ["formatted", "turns", "path", "shard", "a.b"]:
        frame = frame.withColumn(name, F.lit("x"))
    frame.repartition(4).write.parquet(f"{folder}/conversations.parquet")
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "a b " * 9, "  x y z\n" * 4, "ab ab\x0bab \x0c ab ab ab", "é é é é é é é"]
    texts += [" ".join(rng.choice("abc") for _ in range(200)) for _ in range(40)]
    texts += [" ".join([*[f"w{i}" for i in range(n)] * k, "end"]) for n, k in ((5, 4), (8, 4), (31, 5), (64, 4), (127, 4), (300, 6))]
    texts += [("a a a a a a b " * 6 + "c ") * 5, "\x85 \xa0 " * 8, "a" * 40_000]
    rows = [(i, t, "x") for i, t in enumerate(texts * 3)] + [(None, "q r " * 5, "x"), (3, "same id " * 8, "x"), (3, "same id " * 8, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("kept", F.lit(1)).withColumn(
        "c.d", F.lit(2)
    ).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def rows_of(folder, table, *columns):
    frame = pq.read_table(f"{folder}/{table}.parquet", columns=list(columns))
    return list(zip(*[c.to_pylist() for c in frame.columns], strict=True))


def turns_of(folder):
    return rows_of(folder, "conversations", "conv_id", "turn", "role", "text")


@pytest.fixture(params=["odd", "sf_dir"])
def folder(request):
    return request.getfixturevalue(request.param)


# Chat formatting.


def test_op11_chat_format(spark, folder):
    got = queries.op11_chat_format(spark, folder).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(brute.chats(turns_of(folder)))
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    whole = {r["conv_id"]: r for r in chat_format.assemble(chat_format.format_turns(turns)).collect()}
    for r in got:
        if r["conv_id"] != -7:
            assert r["formatted_chars"] == len(whole[r["conv_id"]]["formatted"])
            assert r["loss_chars"] == len(
                "".join(
                    chat_format.read_text(whole[r["conv_id"]]["formatted"][a:b], within(whole[r["conv_id"]], a, b))
                    for a, b in whole[r["conv_id"]]["loss"]
                )
            )


def within(row, a, b):
    return iter([x for x in row["attachments"] if a <= x["at"] < b])


def test_whole_conversations_are_read_back_by_their_marks_alone(spark, odd):
    turns = spark.read.parquet(f"{odd}/conversations.parquet").filter("conv_id < 400")
    want = brute.in_turns(turns_of(odd))
    for r in chat_format.assemble(chat_format.format_turns(turns)).collect():
        records = [x.asDict() for x in r["attachments"]]
        got = list(chat_format.read_turns(r["formatted"], records))
        assert sorted(got) == sorted(want[r["conv_id"]])
        for x in records:
            assert r["formatted"][x["at"] :].startswith(chat_format.PLACEHOLDERS[x["kind"]])


def test_typed_parts_become_ordered_placeholders_with_token_counts(spark):
    part = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
    parts = [
        ("text", "see [IMG] ", None, None, None, None, None),
        ("image", "a cat", "c.png", 57, 28, None, None),
        ("audio", None, "s.wav", None, None, 2.0, None),
        ("document", "d", "d.pdf", None, None, None, 3),
        ("image", None, None, None, None, None, None),
        ("video", "as text", "v.mp4", None, None, None, None),
        (None, None, None, None, None, None, None),
        None,
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "two words", None, None, None, None, None)]), (2, 0, "x", None), (3, 0, "user", [])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    got = {(r["conv_id"], r["turn"]): r for r in chat_format.format_turns(turns, "parts", queries.vocabulary_path()).collect()}
    first = got[1, 0]
    assert first["formatted"] == "[INST]see [\\IMG] [IMG][AUDIO][DOC][IMG]as text[/INST]"
    assert [(a["part"], a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]] == [
        (1, "image", "c.png", 3),
        (2, "audio", "s.wav", 25),
        (3, "document", "d.pdf", 1536),
        (4, "image", None, 256),
    ]
    words = sum(len(ids) - 1 for ids in brute.token_ids(["see [IMG] ", "as text"], queries.vocabulary_path()))
    assert first["tokens"] == 3 + 25 + 1536 + 256 + words
    assert got[1, 1]["formatted"][got[1, 1]["loss_start"] : got[1, 1]["loss_end"]] == "two words"
    assert got[2, 0]["formatted"] == "[ROLE]x[/ROLE]</s>" and got[2, 0]["loss_start"] is None
    assert got[3, 0]["formatted"] == "[INST][/INST]"


def test_no_escaped_text_holds_a_mark():
    rng = random.Random(8)
    letters = ["[", "]", "<", "/", "s>", "INST", "ROLE", "\\", "IMG]", "[/INST]", "</s>", "x"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(12)))
        shown = chat_format.escape(text)
        assert not any(mark in shown for mark in chat_format.CONTROL)
        assert chat_format.unescape(shown) == text


# The prefix trie.


def test_op12_prefix_trie(spark, folder):
    got = Counter(tuple(r) for r in queries.op12_prefix_trie(spark, folder).select(*prefix_trie.NODES).collect())
    assert got == Counter(brute.trie(brute.rebuilt(turns_of(folder))))


@pytest.mark.parametrize("bytes_", [0, 400, 1 << 20])
def test_any_number_of_splitters_gives_the_same_trie(spark, odd, monkeypatch, bytes_):
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", bytes_)
    monkeypatch.setattr(prefix_trie, "SAMPLED_PER_SHARD", 2)
    monkeypatch.setattr(prefix_trie, "SHARDS_PER_PARTITION", 30)
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 3)
    paths = prefix_trie.paths(spark.read.parquet(f"{odd}/conversations.parquet"))
    got = Counter(tuple(r) for r in prefix_trie.prefix_trie(paths).select(*prefix_trie.NODES).collect())
    turns = brute.in_turns(r for r in turns_of(odd) if r[0] is not None)
    assert got == Counter(brute.trie(turns))


def test_copies_of_a_conversation_are_split_over_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARDS_PER_PARTITION", 10)
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(2)]
    paths = prefix_trie.paths(spark.createDataFrame(rows, TURNS))
    keyed = paths.select(F.unhex(F.array_join("turns.digest", "")).alias("path"), "conv_id")
    splitters = prefix_trie.draw_splitters(keyed, 40, 9000)
    shards = Counter(prefix_trie.Skeleton(splitters).shard(bytes(r["path"]), r["conv_id"]) for r in keyed.collect())
    assert len(shards) > 20 and max(shards.values()) < 600
    root, first, second = sorted(prefix_trie.prefix_trie(paths).collect(), key=lambda r: r["depth"])
    assert root["n_convs"] == first["n_convs"] == second["n_convs"] == 3000
    assert second["ends_sha256"] == brute.sha256(",".join(map(str, range(3000))))
    assert root["saved_tokens"] == 2 * 2999 * 6


# Periodic runs.


def test_op13_periodic_runs(spark, folder):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = Counter(tuple(r) for r in queries.op13_periodic_runs(spark, folder).select(*columns).collect())
    docs = [(d, t) for d, t in rows_of(folder, "documents", "doc_id", "text") if len(t or "") < 15_000 or " " not in t]
    want = Counter(brute.periodic_runs(docs))
    assert not want - got
    assert sum(got.values()) == len(rows_of(folder, "documents", "doc_id"))


@pytest.mark.parametrize("seed", range(6))
def test_every_run_is_found(seed):
    rng = random.Random(seed)

    def piece(depth):
        if depth == 0 or rng.random() < 0.4:
            return [rng.randrange(words) for _ in range(rng.randrange(1, 12))]
        if rng.random() < 0.7:
            part = piece(depth - 1)
            return (part * rng.randrange(1, 8))[: rng.randrange(1, 400)]
        return piece(depth - 1) + piece(depth - 1)

    seen = 0
    for _ in range(150):
        words = rng.choice([1, 2, 3, 5, 50])
        docs = [[w for _ in range(4) for w in piece(3)][:400] for _ in range(rng.randrange(1, 6))]
        texts = pa.array([" ".join(f"w{w}" for w in d) for d in docs], pa.string())
        for d, (n, runs, kept) in zip(docs, periodic_runs.document_runs(texts, 4, 6), strict=True):
            want = brute.runs(d)
            assert (n, runs) == (len(d), want)
            gone = {i for start, length, q in want for i in range(start + q, start + length)}
            assert kept.decode() == " ".join(f"w{w}" for i, w in enumerate(d) if i not in gone)
            seen += len(want)
    assert seen > 300


def test_planted_words_are_those_of_the_contract(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planted = {r["doc_id"]: r["text"] for r in queries.with_planted_runs(docs).collect()}
    texts = dict(rows_of(sf_dir, "documents", "doc_id", "text"))
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 for d in texts)
    for d, text in texts.items():
        assert brute.WORD.findall(planted[d] or "") == brute.planted_runs(d, text)


def test_fewer_than_four_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(spark.createDataFrame([(1, "a")], "doc_id long, text string"), powers=3)
