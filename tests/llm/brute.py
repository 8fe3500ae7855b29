"""Plain readings of the contracts, one row after the other, for comparison."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def token_ids(texts, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def pieces(docs, path, capacity):
    """(doc_id, piece, start, length, crc) of every piece."""
    out = []
    for (doc_id, _), ids in zip(docs, token_ids([t for _, t in docs], path), strict=True):
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id, i, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def dedup_lines(docs, min_docs=10):
    lines = [(d, (t or "").split("\n")) for d, t in docs]
    keys = [[lower_ascii(line.strip(BLANK)) for line in ls] for _, ls in lines]
    seen = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for (d, ls), ks in zip(lines, keys, strict=True):
        stay = [line for line, k in zip(ls, ks, strict=True) if not k or seen[k] < min_docs]
        out.append((d, len(ls), len(ls) - len(stay), sha256("\n".join(stay))))
    return out


def warc(pages):
    payload = [(p, (h or "").encode()) for p, h in pages]
    largest = {}
    for p, data in payload:
        if p is not None:
            largest[data] = max(p, largest.get(data, p))
    out = []
    for p, data in payload:
        original = largest.get(data)
        refers = None if original is None or original == p else original
        kind = "response" if refers is None else "revisit"
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, refers))
    return out


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(docs):
    """(doc_id, counts by kind, sha of the base spans, the base spans)."""
    out = []
    for d, t in docs:
        found = []
        for order, (kind, pattern) in enumerate(BASE.items()):
            for m in pattern.finditer(t or ""):
                digits = re.sub("[^0-9]", "", m.group())
                good = {
                    "email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15,
                }[kind]()
                if good:
                    found.append((m.start(), order, m.end(), kind))
        spans = [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]
        count = Counter(k for *_, k in found)
        out.append((d, *[count[k] for k in BASE], sha256(",".join(spans)), spans))
    return out


def quality(docs):
    out = []
    for d, t in docs:
        t = t or ""
        words = WORD.findall(t)
        windows = defaultdict(list)
        for i in range(len(words) - 7):
            windows[tuple(words[i : i + 8])].append(i)
        covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
        lines = [line for line in t.split("\n") if WORD.search(line)]
        row = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        out.append((d, *row, len(words) < 20 or 100 * len(covered) > 30 * len(words)))
    return out


def remove_repeats(docs, window=20):
    order = lambda d: math.inf if d is None else d
    words = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, ws in words:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            first[key] = min(first.get(key, (math.inf, math.inf)), (order(d), i))
    out = []
    for d, ws in words:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (order(d), i):
                gone.update(range(i, i + window))
        out.append((d, len(ws), len(gone), sha256(" ".join(w for i, w in enumerate(ws) if i not in gone))))
    return out


def top_k(rows, every, k):
    good = []
    for v, x in rows:
        if v is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            good.append((v, [math.floor(1024 * float(c)) for c in x]))
    out, asked = [], {}
    for v, x in good:
        if v % every == 0:
            asked[v] = min(x, asked.get(v, x))
    for q, x in asked.items():
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), v) for v, y in good if v != q and len(y) == len(x)]
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scored)[:k])]
    return out


def simhash(docs, shingle=3, distance=3):
    prints = []
    for _, t in docs:
        words = WORD.findall(lower_ascii(t or ""))
        runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[i + 1 :]:
            if (p ^ q).bit_count() <= distance:
                root[find(q)] = find(p)
    least = {}
    for (d, _), p in zip(docs, prints, strict=True):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [(d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(docs, prints, strict=True)]


def sizes(docs):
    return [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs]


def in_turns(rows):
    """Conversation by id: its (role, text) in order of turn, nulls first; ties must be equal rows."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in held.items()}


def chats(rows):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) of every conversation and the planted one."""
    said = "</s>[INST] ok [/INST]"
    out = []
    for c, turns in in_turns([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]).items():
        learnt = "".join(text for role, text in turns if role == "assistant")
        digest = sha256("".join(f"{role}\n{text}\n" for role, text in turns))
        out.append((c, len(turns), digest, len(learnt), sha256(learnt)))
    return out


def rebuilt(rows):
    turns = in_turns(r for r in rows if r[0] is not None)
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # of an id below zero, as in SQL, the multiple above it
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def trie(convs):
    """Every node's contract columns, from all prefixes of all conversations."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    return [
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p])
        + (sha256(",".join(map(str, sorted(ends[p])))),)
        for p, own in members.items()
    ]


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:], strict=False)))


def runs(words, powers=4, least=6):
    """(start, length, period) of every run, by comparing at every distance."""
    out = []
    for q in range(1, len(words) // powers + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, powers * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
            i += i == start
    return sorted(out)


def planted_runs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def periodic_runs(docs):
    """The contract columns of every document."""
    out = []
    for doc_id, text in docs:
        words = planted_runs(doc_id, text)
        found = runs(words)
        gone = {i for start, length, q in found for i in range(start + q, start + length)}
        best = None
        for run in found:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join("%d,%d,%d\n" % run for run in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(found), *shown, sha256(listed), sha256(kept)))
    return out


def mixing(docs, languages, topics, keep, flatten, most=0.9, sweeps=400):
    """By position: (language class, topic class, tokens, probability, sampled); plain raking with bisected sources."""
    rows = []
    for d in docs:
        text = d["text"]
        topic = "*"
        if text is not None:
            topic = "contact" if re.search("@|[0-9]{4}", text) else "short" if len(text) < 1000 else "long"
        language = d["lang"] if d["lang"] in languages else "*"
        rows.append((d["source"], language, topic if topic in topics else "*", len(re.findall(WORD, text or ""))))
    cells = defaultdict(int)
    for source, language, topic, n in rows:
        cells[source, language, topic] += n
    total = sum(cells.values())
    budget = keep * total

    def wanted(named, side):
        have = defaultdict(int)
        for key, n in cells.items():
            have[key[side]] += n
        have = {c: n for c, n in have.items() if n}
        left = 1 - sum(named.values())
        if left < 1e-9 and "*" in have:
            left = have["*"] / total
            scale = (1 - left) / sum(w for c, w in named.items() if c in have)
        else:
            scale = 1
        share = {c: named[c] * scale if c in named else left for c in have}
        share = {c: w / sum(share.values()) for c, w in share.items()}
        held = {}
        while over := {c for c in share if c not in held and share[c] > most * have[c] / budget + 1e-15}:
            held |= {c: most * have[c] / budget for c in over}
            rest = sum(w for c, w in share.items() if c not in held)
            share = {c: held.get(c, w * (1 - sum(held.values())) / rest) if rest else held[c] for c, w in share.items()}
        return share

    goals = [wanted(languages, 1), wanted(topics, 2)]
    sources = defaultdict(list)
    for (source, language, topic), n in cells.items():
        sources[source].append((language, topic, n))
    size = {s: sum(n for *_, n in own) for s, own in sources.items()}
    flat = {s: n**flatten if n else 0 for s, n in size.items()}
    factors = [dict.fromkeys(goals[0], 1.0), dict.fromkeys(goals[1], 1.0)]
    for _ in range(sweeps):
        chance = {}
        for s, own in sources.items():
            target = budget * flat[s] / sum(flat.values())
            x = [(lang, t, n, factors[0].get(lang, 0) * factors[1].get(t, 0)) for lang, t, n in own]
            low, high = 0.0, 1 / min((v for *_, n, v in x if v and n), default=1.0)
            for _ in range(60):
                a = (low + high) / 2
                low, high = (a, high) if sum(n * min(1, a * v) for *_, n, v in x) < target else (low, a)
            chance |= {(s, lang, t): min(1, high * v) for lang, t, n, v in x}
        for side in (0, 1):
            drawn = defaultdict(float)
            for key, n in cells.items():
                drawn[key[side + 1]] += n * chance[key]
            all_ = sum(drawn.values()) / sum(goals[side].values())
            step = {c: w * all_ / drawn[c] for c, w in goals[side].items()}
            factors[side] = {c: f * step[c] for c, f in factors[side].items()}
            chance = {key: p * step.get(key[side + 1], 1.0) for key, p in chance.items()}
            if side == 0:
                first = step
    assert all(abs(v - 1) < 1e-5 for v in [*first.values(), *step.values()])
    return [(language, topic, n, min(1.0, chance[source, language, topic])) for source, language, topic, n in rows]


def drawn(doc_id, seed=1):
    """The uniform number of a document."""
    seed = xxhash.xxh64(struct.pack("<i", seed), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<q", doc_id), seed=seed).intdigest() % 2**52 / 2**52
