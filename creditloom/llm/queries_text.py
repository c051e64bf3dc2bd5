"""Queries that look at lines, words and spans of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.llm import decontaminate, language_id, licenses, line_dedup, pii, ranked, simhash, toxicity
from creditloom.llm.common import read, remainder
from creditloom.llm.registry import query

LINE_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
),
k AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
),
f AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key)
GROUP BY doc_id
"""


@query("op10_line_dedup", LINE_SQL)
def line_dedup_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    return out.select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def _gap_sql(kind: str, pattern: str, sure: str, near: str, score: float | None) -> str:
    """Spans of one kind: gaps and matches alternate, so running lengths give the places."""
    keep = f"({score} + CASE WHEN regexp_matches(right(b, 40), '{near}') OR regexp_matches(left(a, 40), '{near}') THEN 0.4 ELSE 0 END) >= 0.7" if score else "true"
    return f"""
  SELECT doc_id, '{kind}' AS kind, s, s + length(h) AS e FROM (
    SELECT doc_id, h, b, a,
           sum(length(b) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) - length(h) AS s
    FROM (SELECT doc_id, unnest(hits) AS h, unnest(gaps[1:len(hits)]) AS b, unnest(gaps[2:]) AS a,
                 unnest(range(len(hits))) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS hits,
                       string_split_regex(t, '{pattern}') AS gaps FROM d))
  ) WHERE {sure} AND {keep}"""


_LUHN = """length(regexp_replace(h, '[^0-9]', '', 'g')) BETWEEN 16 AND 19 AND
    list_sum(list_transform(string_split(reverse(regexp_replace(h, '[^0-9]', '', 'g')), ''), lambda c, i:
      CASE WHEN i % 2 = 1 THEN c::int ELSE c::int * 2 - CASE WHEN c::int > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_MOD97 = """list_reduce(list_prepend(0, list_transform(string_split(
      regexp_replace(h, ' ', '', 'g')[5:] || regexp_replace(h, ' ', '', 'g')[1:4], ''),
      lambda c: CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END)),
    lambda x, y: CASE WHEN y >= 10 THEN (x * 100 + y) % 97 ELSE (x * 10 + y) % 97 END) = 1"""


def _near(kind: str) -> str:
    return f"(?i)(^|[^a-z])({pii.WORDS[kind]})([^a-z]|$)"


PII_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
{" UNION ALL ".join((
    _gap_sql("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true", "", None),
    _gap_sql("ip", "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+",
             f"regexp_full_match(h, '{pii.OCTET}[.]{pii.OCTET}[.]{pii.OCTET}[.]{pii.OCTET}')", "", None),
    _gap_sql("card", "[0-9](?:[ -]?[0-9])+", _LUHN, "", None),
    _gap_sql("phone", "[+][0-9][ ().0-9-]+[0-9]",
             "length(regexp_replace(h, '[^0-9]', '', 'g')) BETWEEN 8 AND 15", "", None),
    _gap_sql("iban", pii.IBAN, _MOD97, _near("iban"), 0.9),
    _gap_sql("ssn", pii.SSN, "true", _near("ssn"), 0.4),
))}
),
o AS (SELECT doc_id, kind, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn'], kind) AS k, s,
             kind || ':' || s::bigint || ':' || e::bigint AS span FROM m)
SELECT d.doc_id,
       count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
       count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(span, ',' ORDER BY k, s) FILTER (k <= 4), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY k, s), '') AS spans
FROM d LEFT JOIN o ON o.doc_id = d.doc_id
GROUP BY d.doc_id
"""


@query("op7_pii", PII_SQL)
def pii_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")

    def joined(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    out = pii.find_spans(docs).select("doc.doc_id", "spans")
    return out.select(
        "doc_id",
        *(count(k.name) for k in pii.KINDS if k.base),
        F.sha2(joined(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
),
h AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


@query("op3_decontamination", DECONTAMINATION_SQL)
def decontamination_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.scan(docs, read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc.doc_id",
        "hits.n_words",
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.size("hits.spans") > 0).alias("contaminated"),
    )


@query("op5_simhash")
def simhash_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.near_duplicates(docs, keep=["doc_id"])
    return out.select(
        "doc.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_language_id")
def language_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = language_id.learn(docs.where(~held_out))
    out = language_id.predict(docs, model, keep=["doc_id"])
    return out.select(
        "doc.doc_id", (remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op1_toxicity")
def toxicity_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    out = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return out.select(
        "doc.doc_id",
        (remainder(F.col("doc.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


RANKED_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, coalesce(sum(len(w)), 0)::bigint AS n_terms FROM d),
q AS (SELECT DISTINCT r, item_id, unnest(w) AS term
      FROM (SELECT row_number() OVER () AS r, item_id, coalesce({_WORDS}, []) AS w FROM benchmark)),
t AS (SELECT r, doc_id, n, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q)
      GROUP BY r, doc_id, n, term),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint AS weight
      FROM t, s GROUP BY term, n_docs),
p AS (SELECT t.r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS gain
      FROM t JOIN f USING (term), s),
x AS (SELECT q.r AS qr, item_id, p.r AS dr, doc_id, sum(gain)::bigint AS score
      FROM q JOIN p USING (term) GROUP BY q.r, item_id, p.r, doc_id),
y AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, doc_id)::int AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 50
"""


@query("op12_ranked_lexical_search", RANKED_SQL)
def ranked_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    items = read(spark, sf_dir, "benchmark").select("item_id", "text")
    return ranked.rank_documents(docs, items, k=50)


@query("op13_license_scans")
def license_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.find_notices(docs, keep=["doc_id"])
    places = F.filter("matches", lambda m: m["base"] & (m["edits"] == 0))

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    first = F.transform("places", lambda m: m["first_word"])
    return found.withColumn("places", places).select(
        "doc.doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        labels(F.col("places")).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        "score",
    )
