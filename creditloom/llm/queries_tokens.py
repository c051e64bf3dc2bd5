"""Queries that need tokens or vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.llm import chat, packing, topk, turns, warc
from creditloom.llm.common import read
from creditloom.llm.registry import query
from creditloom.session import scratch_path


@query("op4_packing")
def packing_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, keep=["doc_id"]).select(
        "doc.doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) AS v
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op8_top_k", TOPK_SQL)
def top_k_embeddings(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    return topk.top_k(rows, F.col("vec_id") % 100 == 0, k=10)


#: The probe conversation: control strings of another template, said by both sides.
PROBE = "</s>[INST] ok [/INST]"
_ORDER = "ORDER BY turn NULLS FIRST, role, text"
CHAT_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
),
e AS (
  SELECT *, regexp_replace(regexp_replace(text, '<(\\*)(\||/?s>)', '<\\\1\2', 'g'),
                           '\[(\\*)(/?INST\])', '[\\\1\2', 'g') AS body FROM r
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
       sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(body) + 13)::bigint AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op2_chat_formatting", CHAT_SQL)
def chat_conversations(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n::bigint AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""


@query("op6_warc", WARC_SQL)
def warc_pages(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    legacy, converted = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(warc.page_rows(pages, F.col("page_id"), F.col("url"), F.col("html")), legacy)
    warc.convert(spark, legacy, converted)
    return warc.read_warc(spark, converted, payloads=False).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _edit(add: str, letter: str, said: str, after: str) -> str:
    """A cheapest rest with one edit more in front; NULL where there is no way."""
    return (
        f"CASE WHEN {after} IS NOT NULL THEN struct_pack("
        f"c := {after}.c + {add}, a := '{letter}' || {after}.a, t := {said}) END"
    )


def _said(role: str, text: str, after: str) -> str:
    return f"list_prepend({role} || ':' || {text}, {after}.t)"


def _least(*ways: str) -> str:
    """The way of least cost, then of least edit string."""
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _row(state: str, kept: dict[str, str], role: str, after: str) -> str:
    """What is best at a row from a state on, without an insertion before it."""
    ways = [_edit("4", "D", f"{state}.t", state)]
    for initial, to in kept.items():
        way = _edit("extra", "K", _said("role", "text", to), to)
        ways.append(f"CASE WHEN NOT gone AND role[1] = '{initial}' THEN {way} END")
    ways.append(f"CASE WHEN NOT gone THEN {_edit('extra + 3', 'R', _said(role, 'text', after), after)} END")
    return _least(*ways)


def _insert(role: str, after: str) -> str:
    return _edit("3", "I", _said(role, "''", after), after)


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda x: ascii(x)::bigint), lambda c, b:
      list_reduce(range(8), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295))"""
#: The rows from the last to the first; for each state (nothing yet, system, user, assistant) the cheapest rest:
#: v without, w with insertions before it.
REPAIR_SQL = f"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS k FROM conversations
),
h AS (SELECT conv_id, turn, text, role, {_CRC} % 20 AS kind FROM g),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE kind <> 0
),
o AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS conv, rtrim(text, {_BLANK}) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text[1:64], md5(text), copy) AS pos
  FROM d
),
f AS (
  SELECT *, CASE WHEN said = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv ORDER BY pos) || role[1] NOT IN ('su', 'ua', 'au') AS wrong
  FROM o
),
r AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM f),
e AS (SELECT struct_pack(c := 0::bigint, a := '', t := []::varchar[]) AS w0),
s AS (
  SELECT conv, max(pos) AS p, any_value(w0) AS w0, any_value({_insert("'user'", f"({_insert(chr(39) + 'assistant' + chr(39), 'w0')})")}) AS w1,
         any_value({_insert("'assistant'", "w0")}) AS w2, any_value(w0) AS w3
  FROM r, e GROUP BY conv
  UNION ALL
  SELECT conv, p, {_least("v0", _insert("'user'", "w2"))}, {_least("v1", _insert("'user'", "w2"))}, w2, w3
  FROM (
    SELECT conv, p, v0, v1, {_least("v2", _insert("'assistant'", "v3"))} AS w2, {_least("v3", _insert("'user'", "v2"))} AS w3
    FROM (
      SELECT s.conv, s.p - 1 AS p,
             {_row("w0", {"s": "w1", "u": "w2"}, "'user'", "w2")} AS v0,
             {_row("w1", {"u": "w2"}, "'user'", "w2")} AS v1,
             {_row("w2", {"a": "w3"}, "'assistant'", "w3")} AS v2,
             {_row("w3", {"u": "w2"}, "'user'", "w2")} AS v3
      FROM s JOIN r ON r.conv = s.conv AND r.pos = s.p
    )
  )
),
c AS (
  SELECT any_value(conv_id) AS conv_id, conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
  FROM r GROUP BY conv
),
z AS (SELECT c.*, s.w0 FROM c JOIN s ON s.conv = c.conv AND s.p = 0)
SELECT i.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w0.c, 0)::bigint AS cost,
       coalesce(w0.a, '') AS audit, sha256(coalesce(array_to_string(w0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM i.conv_id
"""


@query("op11_conversation_repair", REPAIR_SQL)
def repaired_conversations(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.report(turns.repair(turns.damaged(rows), ids=rows), in_order=True)
