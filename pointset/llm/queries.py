"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import langid
from .licenses import scan_licenses
from .line_quality import clean_lines
from .minmax_dedup import near_duplicates
from .mixing import mix_sources
from .packing import pack
from .pii import find_personal_data
from .pivot_index import near_vectors
from .shared import fresh_path, read_table
from .substring_dedup import remove_repeats
from .token_store import checksums, read_tokens, write_tokens
from .turns import damage, repair_conversations
from .warc import read_warc, write_warc
from .whitening import whiten


def op1_warc(spark, d):
    folder = fresh_path(spark, "warc")
    write_warc(read_table(spark, d, "pages"), folder)
    records = read_warc(spark, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op2_mixing(spark, d):
    mixed = mix_sources(read_table(spark, d, "documents"))
    per_doc = mixed.groupBy("doc_id", "_row", "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    return per_doc.select("doc_id", "size", "source_size", "target", "taken")


def op3_pii(spark, d):
    return find_personal_data(read_table(spark, d, "documents"), with_text=False).drop("redacted")


def op4_language(spark, d):
    docs = read_table(spark, d, "documents")
    network = langid.train_network(docs)
    rows = langid.identify(docs, network)
    return rows.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_substring(spark, d):
    found = remove_repeats(read_table(spark, d, "documents"), digest=True)
    return found.withColumnRenamed("kept", "kept_sha256")


def op6_minmax(spark, d):
    found = near_duplicates(read_table(spark, d, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_tokens(spark, d):
    folder = fresh_path(spark, "tokens")
    write_tokens(
        read_table(spark, d, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end=2, spaced=False
    )
    rows = read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_pivots(spark, d):
    return near_vectors(read_table(spark, d, "embeddings"))


def op9_packing(spark, d):
    return pack(read_table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_lines(spark, d):
    return clean_lines(read_table(spark, d, "documents"), with_text=False).drop("text")


def op11_licenses(spark, d):
    return scan_licenses(read_table(spark, d, "documents")).drop("spans")


def op12_whitening(spark, d):
    return whiten(read_table(spark, d, "embeddings"))


def op13_turns(spark, d):
    rows = damage(read_table(spark, d, "conversations"))
    return repair_conversations(rows, F.col("present"))[0]


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_pii": op3_pii,
    "op4_language": op4_language,
    "op5_substring": op5_substring,
    "op6_minmax": op6_minmax,
    "op7_tokens": op7_tokens,
    "op8_pivots": op8_pivots,
    "op9_packing": op9_packing,
    "op10_lines": op10_lines,
    "op11_licenses": op11_licenses,
    "op12_whitening": op12_whitening,
    "op13_turns": op13_turns,
}

_WORDS = "regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"

_WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to, true AS complete
FROM p LEFT JOIN f USING (payload_digest)"""

_SUBSTRING_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="text")} AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps
         FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (h)) GROUP BY doc_id),
k AS (SELECT doc_id, ws, coalesce(ps, []) AS ps FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(ws) AS n_words, len(ps) AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM k"""

_REACH = """
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT u AS node, u AS other FROM both_ways
          UNION SELECT r.node, b.v FROM reach r JOIN both_ways b ON b.u = r.other),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

_MINMAX_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws ELSE
        list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT doc_id, n, sh FROM s JOIN n USING (doc_id)),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM t a JOIN t b
          ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
{_REACH}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN component c ON c.node = w.doc_id"""

_VECTORS_SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b
          ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
{_REACH},
counts AS (SELECT u, count(*) AS n FROM both_ways GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component ON node = vec_id LEFT JOIN counts ON u = vec_id"""

# Faults, and the dynamic programme with whole audits and texts instead of ways back.
_TURNS_SQL = r"""
WITH RECURSIVE bytes_crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c
    FROM (SELECT unnest(range(256)) AS i))),
raw AS (
  SELECT conv_id AS c, turn AS t, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fated AS (
  SELECT c, t, role, txt, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
      lambda h, b: xor(h >> 8, tab[(xor(h, b) & 255) + 1]))) % 20 AS fate FROM raw, bytes_crc),
copies AS (
  SELECT c, t, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(txt, '.!?', '') ELSE txt END AS txt
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY t NULLS FIRST, role, txt, copy) AS n,
         regexp_replace(txt, '[\x20\x09-\x0D]+$', '') AS bare FROM copies),
marked AS (
  SELECT c, t, n, role, txt, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY n) AS prev,
         CASE WHEN bare = '' THEN 2 WHEN row_number() OVER (PARTITION BY c, role, txt ORDER BY n) > 1 THEN 3
              WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault FROM placed),
facts AS (
  SELECT c, coalesce(max(t) - min(t) + 1 - count(DISTINCT t), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
         count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS rows_left
  FROM marked GROUP BY c),
-- places in the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a
goes AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) v(q, ini, to_q)),
named AS (SELECT * FROM (VALUES ('u', 'user'), ('a', 'assistant')) v(ini, name)),
into_1 AS (SELECT q, to_q, [name || ':'] AS ins FROM goes JOIN named USING (ini)),
fills AS (
  SELECT q, q AS at_q, 0 AS k, []::VARCHAR[] AS ins FROM (SELECT unnest(range(4))::INT AS q)
  UNION ALL SELECT q, to_q, 1, ins FROM into_1
  UNION ALL SELECT a.q, b.to_q, 2, list_concat(a.ins, b.ins) FROM into_1 a JOIN into_1 b ON b.q = a.to_q),
best AS (
  SELECT c, 0::BIGINT AS n, 0::INT AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS kept FROM facts
  UNION ALL
  SELECT c, n, q, cost, audit, kept FROM (
    SELECT *, row_number() OVER (PARTITION BY c, q ORDER BY cost, audit) AS place FROM (
      SELECT b.c, m.n, f.at_q AS q, b.cost + 5 * f.k + 2 AS cost, b.audit || repeat('I', f.k) || 'D' AS audit, list_concat(b.kept, f.ins) AS kept
      FROM best b JOIN marked m ON m.c IS NOT DISTINCT FROM b.c AND m.n = b.n + 1 JOIN fills f ON f.q = b.q
      UNION ALL
      SELECT b.c, m.n, g.to_q, b.cost + 5 * f.k + 5 * m.fault, b.audit || repeat('I', f.k) || 'K', list_append(list_concat(b.kept, f.ins), m.role || ':' || m.txt)
      FROM best b JOIN marked m ON m.c IS NOT DISTINCT FROM b.c AND m.n = b.n + 1 AND m.fault < 2
      JOIN fills f ON f.q = b.q JOIN goes g ON g.q = f.at_q AND g.ini = m.ini
      UNION ALL
      SELECT b.c, m.n, g.to_q, b.cost + 5 * f.k + 5 * m.fault + 1, b.audit || repeat('I', f.k) || 'R', list_append(list_concat(b.kept, f.ins), r.name || ':' || m.txt)
      FROM best b JOIN marked m ON m.c IS NOT DISTINCT FROM b.c AND m.n = b.n + 1 AND m.fault < 2
      JOIN fills f ON f.q = b.q JOIN goes g ON g.q = f.at_q JOIN named r ON r.ini = g.ini))
  WHERE place = 1),
done AS (
  SELECT b.c, b.cost + 5 * f.k AS cost, b.audit || repeat('I', f.k) AS audit, list_concat(b.kept, f.ins) AS kept
  FROM best b JOIN facts x ON x.c IS NOT DISTINCT FROM b.c AND x.rows_left = b.n JOIN fills f ON f.q = b.q AND f.at_q IN (0, 3)),
least AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY cost, audit) AS place FROM done)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN facts x ON x.c IS NOT DISTINCT FROM i.conv_id
LEFT JOIN least l ON l.c IS NOT DISTINCT FROM i.conv_id AND l.place = 1"""

# The others hold models, tokenizers or a keyed order of another engine's hash.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": _WARC_SQL,
    "op5_substring": _SUBSTRING_SQL,
    "op6_minmax": _MINMAX_SQL,
    "op8_pivots": _VECTORS_SQL,
    "op13_turns": _TURNS_SQL,
}
