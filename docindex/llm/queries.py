"""The registered queries of this package and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docindex.llm.alignment import alignment
from docindex.llm.chat import chats
from docindex.llm.decontaminate import contamination
from docindex.llm.exact_dedup import exact_groups
from docindex.llm.language import languages
from docindex.llm.near_dedup import near_classes
from docindex.llm.pages import extract
from docindex.llm.pieces import round_trip
from docindex.llm.quality import quality
from docindex.llm.suffix_dedup import cleaned
from docindex.llm.token_files import token_index
from docindex.llm.variants import variants
from docindex.llm.warc import archived
from docindex.plans.common import Registry, table

REGISTRY = Registry()

EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM d WINDOW w AS (PARTITION BY body ORDER BY length(text) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""


@REGISTRY.add("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@REGISTRY.add("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"))


@REGISTRY.add("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


# Words, windows of thirteen (or a shorter item whole), and the words that equal windows cover.
CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), h AS (
  SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k
), c AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS word FROM h) GROUP BY doc_id
), l AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""


@REGISTRY.add("op6_decontamination", CONTAMINATION_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@REGISTRY.add("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@REGISTRY.add("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@REGISTRY.add("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


CHATS_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), c AS (
  SELECT conv_id, count(*) AS n_turns, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM t GROUP BY conv_id
), p AS (
  SELECT conv_id, n_turns, md5(CAST(turns[1:k] AS VARCHAR)) AS prefix
  FROM (SELECT *, unnest(generate_series(1, n_turns)) AS k FROM c)
)
SELECT conv_id, n_turns, array_to_string(list_transform(turns, lambda x:
  '<|im_start|>' || x.role || chr(10) || replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)), '') AS text
FROM c WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE p.prefix = md5(CAST(c.turns AS VARCHAR))
  AND (p.n_turns > c.n_turns OR (p.n_turns = c.n_turns AND p.conv_id < c.conv_id)))
"""


@REGISTRY.add("op3_chat_format", CHATS_SQL)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(table(spark, sf_dir, "conversations"))


@REGISTRY.add("op4_near_dedup")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


@REGISTRY.add("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "documents"))


# SHA-1 in hex digits, five of which make four letters of base32.
ARCHIVE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC) AS place, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head
  FROM pages
), d AS (
  SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(sha1(body), 5 * g + 1, 5) AS INTEGER)) AS parts FROM p
)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((parts[1 + k // 4] >> (15 - 5 * (k % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN head END AS refers_to
FROM d
"""


@REGISTRY.add("op11_warc", ARCHIVE_SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


@REGISTRY.add("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


# The check sum's table comes from its polynomial; two words are near if one without a character, or with a gap for one, is the other.
VARIANTS_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT DISTINCT doc_id, run, count(*) OVER (PARTITION BY doc_id, run) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents)
), hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(key))),
    lambda i: CAST('0x' || substr(hex(encode(key)), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs), crc
), w AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), own AS (
  SELECT word, n, k, substr(word, 1, k) AS a, substr(word, k + 2) AS b FROM (SELECT *, unnest(range(length(word))) AS k FROM w)
), pairs AS (
  SELECT x.word AS p, y.word AS q FROM own x JOIN own y USING (k, a, b) WHERE x.word < y.word
  UNION SELECT x.word, w.word FROM own x JOIN w ON w.word = x.a || x.b
), near AS (
  SELECT p AS word, q AS other FROM pairs UNION SELECT q, p FROM pairs
), best AS (
  SELECT near.word, count(*) AS n_near, first(near.other ORDER BY w.n DESC, near.other) AS other, max(w.n) AS most
  FROM near JOIN w ON w.word = near.other GROUP BY near.word
), f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN other END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM f JOIN chain USING (word) JOIN f AS z ON z.word = chain.root WHERE z.form IS NULL
"""


@REGISTRY.add("op13_variants", VARIANTS_SQL)
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
