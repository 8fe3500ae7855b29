"""The queries that SQL can express, for another engine."""

from __future__ import annotations

# The blanks of the contracts, and the alphabet of base32.
BLANK = " || ".join(f"chr({c})" for c in (0x20, *range(0x09, 0x0E)))
CAPITALS = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
BASE32 = CAPITALS + "234567"
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
 each AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
 keyed AS (SELECT *, translate(trim(line, {BLANK}), '{CAPITALS}', '{CAPITALS.lower()}') AS key FROM each),
 shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
 marked AS (SELECT k.*, s.key IS NOT NULL AS gone FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""

# A digest of 40 hexadecimal digits in groups of five, 20 bits each, gives four letters a group.
OP3 = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
 hashed AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex FROM payloads),
 grouped AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS original FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
  1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '')
  AS payload_digest,
 CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> original THEN original END AS refers_to
FROM grouped"""

OP7 = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
 starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20),
 windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS run FROM starts),
 ranked AS (SELECT doc_id, i, rank() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 AS again FROM windows),
 each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM docs),
 covered AS (SELECT e.doc_id, e.j, e.word, max(CASE WHEN r.again THEN r.i END)
   OVER (PARTITION BY e.doc_id ORDER BY e.j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM each e LEFT JOIN ranked r ON r.doc_id = e.doc_id AND r.i = e.j),
 kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS left_over
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
 sha256(coalesce(k.left_over, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

OP8 = """
WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10"""

# The turns as the template writes them: an attachment's notation counts as its placeholder.
ENDINGS = {"IMG": "png|jpe?g|gif|webp", "AUDIO": "mp3|wav|flac|ogg", "DOC": "pdf|docx?|txt|csv"}


def _escaped(text: str) -> str:
    doubled = f"replace({text}, '\\', '\\\\')"
    angle = f"regexp_replace({doubled}, '<(/s>)', '<\\\\\\1', 'g')"
    return f"regexp_replace({angle}, '\\[(/?INST\\]|/?ROLE\\]|IMG\\]|AUDIO\\]|DOC\\])', '[\\\\\\1', 'g')"


def _attachments(text: str) -> str:
    for mark, endings in ENDINGS.items():
        by = "\x01" * (len(mark) + 2)
        text = f"regexp_replace({text}, '!\\[[^\\]\\n]*\\]\\([^)\\s]+\\.({endings})\\)', '{by}', 'g')"
    return text


OP11 = f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
 written AS (SELECT *, {_escaped(_attachments("text"))} AS content, {_escaped("role")} AS name FROM said),
 formatted AS (SELECT *, CASE role WHEN 'user' THEN '[INST]' || content || '[/INST]' WHEN 'assistant' THEN content || '</s>'
  ELSE '[ROLE]' || name || '[/ROLE]' || content || '</s>' END AS formatted FROM written)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id"""

# The checksum of the decimal id, bit by bit; every conversation's prefixes as texts.
CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""
OP12 = f"""
WITH hashed AS (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
  sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
 placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k FROM hashed),
 ids AS (SELECT conv_id, {CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM placed)),
 rebuilt AS (SELECT i.conv_id, p.k, p.digest, p.size FROM ids i JOIN placed p
   ON p.conv_id = i.conv_id - i.conv_id % 5 AND p.k <= i.h
  UNION ALL SELECT i.conv_id, p.k, p.digest, p.size FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND p.k > i.h),
 prefixes AS (SELECT conv_id, row_number() OVER w AS depth, size,
   md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY k)) AS prefix,
   row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_end
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY k)
  UNION ALL SELECT i.conv_id, 0, 0, 'root', NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.conv_id = i.conv_id) FROM ids i),
 nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth),
 tied AS (SELECT n.*, p.prefix AS parent_prefix FROM nodes n LEFT JOIN prefixes p
   ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
 counted AS (SELECT t.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM tied c WHERE c.parent_prefix = t.prefix) AS n_children
  FROM tied t LEFT JOIN nodes u ON u.prefix = t.parent_prefix),
 above AS (SELECT p.prefix, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.size) AS saved
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.prefix)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, c.parent_conv_id, c.n_convs, c.n_children, a.n_leaves,
 CAST(a.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN above a ON a.prefix = c.prefix"""

ORACLES = {
    "op2_line_dedup": OP2,
    "op3_warc_zip": OP3,
    "op7_substring_dedup": OP7,
    "op8_topk": OP8,
    "op11_chat_format": OP11,
    "op12_prefix_trie": OP12,
}
