"""The numbered queries over the documents and pages tables, and their SQL."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hockeylake.llm import license_scan as licenses
from hockeylake.llm.conversations import damage, repair_conversations
from hockeylake.llm.decontaminate import UNITS, contamination_report
from hockeylake.llm.exact_dedup import exact_duplicates
from hockeylake.llm.importance import importance_resample
from hockeylake.llm.language_id import fold, identify_language, train_language_model
from hockeylake.llm.mixing import mixing_plan
from hockeylake.llm.ngram_join import near_duplicate_components
from hockeylake.llm.packing import pack_documents
from hockeylake.llm.pii import pseudonymise
from hockeylake.llm.token_counts import token_counts
from hockeylake.llm.toxicity import score_toxicity, train_toxicity_model
from hockeylake.llm.warc import warc_round_trip


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(_read(spark, sf_dir, "documents"), n=3, part=90, whole=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_read(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")), limit=2048, chunk=16384)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.pseudonym.key``; where that is unset, one that nobody knows, so that pseudonyms can't be turned back and link within this run alone."""
    key = spark.conf.get("spark.pseudonym.key", None) or secrets.token_hex(32)
    return pseudonymise(_read(spark, sf_dir, "documents"), key=key)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = train_toxicity_model(docs, labels.filter(fold("doc_id", 5) != 0))
    scores = score_toxicity(docs, model)
    return scores.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = train_language_model(docs.filter(fold("doc_id", 4) != 2).select("text", "lang"))
    found = identify_language(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), total_share=1.5, most=2.0)
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken", "n_copies", F.array_join("shards", ",").alias("shards"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), any_case=True)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_read(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), least=1, most=1, buckets=10_000, min_words=20, percent=10, seed="2024")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(_read(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")), window=4096, end_id=2)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_read(spark, sf_dir, "conversations"), damaged=damage)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_token_counts, op3_license_scan, op4_warc, op5_pii, op6_toxicity, op7_language_id, op8_mixing, op9_decontamination, op10_exact_dedup, op11_importance_resampling, op12_packing, op13_conversation_repair)
}

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""



def _canonical_sql(text: str) -> str:
    x = f"lower(regexp_replace({text}, '{licenses.COPYRIGHT_LINE}', ' ', 'g'))"
    x = rf"' ' || trim(regexp_replace({x}, '[^\p{{L}}\p{{N}}]+', '  ', 'g')) || ' '"
    for said, meant in licenses.EQUIVALENT:
        x = f"replace({x}, ' {said.replace(' ', '  ')} ', ' {meant.replace(' ', '  ')} ')"
    return f"trim(replace({x}, '  ', ' '))"


def _folded_sql(text: str) -> str:
    return f"replace(replace(lower({text}), 'ß', 'ss'), 'ς', 'σ')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _template_sql(table: str, key: str) -> str:
    units = ", ".join(map(_quoted, UNITS))
    return rf"""
  SELECT {key}, list_transform(range(1, len(t) + 1), lambda i: CASE WHEN i > 1 AND t[i - 1] = chr(2) AND list_contains([{units}], t[i]) THEN chr(3) ELSE t[i] END) AS t FROM (
  SELECT {key}, list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(coalesce(text, ''),
    '([\p{{Ll}}\p{{N}},;:] )(\p{{Lu}}[\p{{L}}\p{{M}}]*(?: \p{{Lu}}[\p{{L}}\p{{M}}]*)*)', '\1 ' || chr(1) || ' ', 'g'),
    '\p{{N}}+(?:[.,:/]\p{{N}}+)*', ' ' || chr(2) || ' ', 'g')), '[^\p{{L}}\p{{M}}\x01-\x03]+'), lambda x: x <> '') AS t FROM {table})"""

#: The 256 remainders of CRC-32, by its rule.
_CRC_TABLE = "crc_table AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i))"


def _crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``t`` is the table."""
    h = f"hex(encode({text}))"
    octets = f"list_transform(range(1, len({h}), 2), lambda i: CAST('0x' || substr({h}, i, 2) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


_FEATURES = "SELECT {id}, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS f FROM {table}"

#: Edits of a turn in each state of the grammar (0 nothing yet, 1 after s, 2 after u, 3 after a): up to two turns put in, then the turn's own edit.
_STEPS = """SELECT q, 3 * len(put) AS cost, put, CASE WHEN put = '' THEN q WHEN (q IN (0, 1, 3)) = (len(put) = 1) THEN 2 ELSE 3 END AS r, CASE WHEN put = '' THEN '' WHEN q = 2 AND len(put) = 1 THEN chr(10) || 'assistant:' WHEN q = 2 THEN chr(10) || 'assistant:' || chr(10) || 'user:'
    WHEN len(put) = 1 THEN chr(10) || 'user:' ELSE chr(10) || 'user:' || chr(10) || 'assistant:' END AS said FROM range(4) a(q), (VALUES (''), ('I'), ('II')) v(put)"""

ORACLE_SQL: dict[str, str] = {
    "op11_importance_resampling": f"""
WITH {_CRC_TABLE},
have AS MATERIALIZED ({_FEATURES.format(id="doc_id", table="documents")}),
want AS MATERIALIZED ({_FEATURES.format(id="item_id", table="benchmark")}),
vocabulary AS MATERIALIZED (SELECT f, {_crc_sql("f")} % 10000 AS b FROM (SELECT f FROM have UNION SELECT f FROM want), crc_table),
s AS (SELECT b, count(*) AS s FROM have JOIN vocabulary USING (f) GROUP BY b), t AS (SELECT b, count(*) AS t FROM want JOIN vocabulary USING (f) GROUP BY b),
gains AS MATERIALIZED (SELECT b, CAST(floor(1000.0 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM have) + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM want) + 10000)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (b)),
weights AS (SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM have JOIN vocabulary USING (f) JOIN gains USING (b) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE {_CRC_TABLE},
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT conv_id, turn, role, text, {_crc_sql("k")} % 20 AS how FROM given, crc_table),
kept AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM kept),
told AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS a, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault,
  lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS b FROM placed),
steps AS MATERIALIZED ({_STEPS}),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS said FROM (SELECT DISTINCT conv_id FROM told)
  UNION ALL
  SELECT conv_id, i, q, best.cost, best.audit, best.said FROM (
    SELECT conv_id, i, q, min({{'cost': cost, 'audit': audit, 'said': said}}) AS best FROM (
      SELECT w.conv_id, t.i, e.q, CAST(w.cost + s.cost + e.cost AS BIGINT) AS cost, w.audit || s.put || e.edit AS audit, w.said || s.said || e.said AS said
      FROM walk w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1 JOIN steps s ON s.q = w.q,
      LATERAL (
        SELECT s.r AS q, 4 AS cost, 'D' AS edit, '' AS said
        UNION ALL SELECT n, CASE WHEN a = x THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, CASE WHEN a = x THEN 'K' ELSE 'R' END, chr(10) || CASE WHEN a = x THEN role WHEN x = 'u' THEN 'user' ELSE 'assistant' END || ':' || text
        FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(p, x, n) WHERE p = s.r AND fault NOT IN ('blank', 'duplicate') AND (x <> 's' OR a = 's')) e)
    GROUP BY conv_id, i, q)),
sizes AS (SELECT conv_id, max(i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (b IS NOT NULL AND b || a NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM told GROUP BY conv_id),
ends AS (SELECT w.conv_id, min({{'cost': w.cost + s.cost, 'audit': w.audit || s.put, 'said': w.said || s.said}}) AS best FROM walk w JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i JOIN steps s ON s.q = w.q WHERE s.r IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(best.cost AS BIGINT), 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * k >= 90 * (len(x.s) + len(y.s) - k)),
two_way AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN two_way l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id FROM sets s JOIN least USING (doc_id)""",
    "op10_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER p AS keep_id, count(*) OVER p AS group_size, doc_id = max(doc_id) OVER p AS kept, sha256(x) AS text_sha256
FROM t WINDOW p AS (PARTITION BY x)""",
    "op3_license_scan": f"""
WITH given AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.default_rows())}) v(license_id, text)),
known AS MATERIALIZED (SELECT {_canonical_sql("text")} AS x, min(license_id) AS license_id, min_by(text, license_id) AS text FROM given GROUP BY 1),
known_run AS MATERIALIZED (SELECT license_id, known, unnest(ps) AS x, unnest(range(len(ps))) AS j, len(ps) AS k FROM (
  SELECT license_id, x AS known, list_filter(list_transform(regexp_split_to_array(text, '{licenses.BLANK_LINES}'), lambda p: {_canonical_sql("p")}), lambda p: p <> '') AS ps FROM known) WHERE len(ps) > 1),
units AS (
  SELECT doc_id, TRUE AS whole, coalesce(text, '') AS u FROM documents
  UNION ALL SELECT doc_id, FALSE, unnest(list_distinct(string_split(coalesce(text, ''), chr(10)))) FROM documents
  UNION ALL SELECT doc_id, FALSE, unnest(list_distinct(list_filter(regexp_split_to_array(text, '{licenses.BLANK_LINES}'), lambda p: contains(p, chr(10))))) FROM documents WHERE regexp_matches(text, '{licenses.BLANK_LINES}')),
runs AS (SELECT doc_id, unnest(ps) AS x, unnest(range(len(ps))) AS i FROM (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '{licenses.BLANK_LINES}'), lambda p: {_canonical_sql("p")}), lambda p: p <> '') AS ps FROM documents WHERE regexp_matches(text, '{licenses.BLANK_LINES}'))),
found AS (
  SELECT doc_id, whole, license_id FROM (SELECT doc_id, whole, {_canonical_sql("u")} AS x FROM units) JOIN known USING (x)
  UNION ALL SELECT doc_id, FALSE, license_id FROM (SELECT doc_id, license_id, known, i - j, k FROM runs JOIN known_run USING (x) GROUP BY ALL HAVING count(DISTINCT j) = k))
SELECT doc_id, min(CASE WHEN whole THEN license_id END) AS text_license, array_to_string(list_sort(list(DISTINCT license_id)), ',') AS licenses, count(*) FILTER (NOT whole) AS n_units
FROM found GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, NULL, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM found)""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS least FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM f""",
    # No item of the benchmark table has a number or a name within a sentence: slots never differ there, so that the SQL leaves out their check.
    "op9_decontamination": f"""
WITH docs AS MATERIALIZED ({_template_sql("documents", "doc_id")}),
items AS MATERIALIZED ({_template_sql("benchmark", "item_id")}),
win AS MATERIALIZED (
  SELECT item_id, k, list_slice(t, k, k + 7) AS w FROM (SELECT item_id, t, unnest(range(1, len(t) - 6)) AS k FROM items)
  WHERE len(list_filter(list_slice(t, k, k + 7), lambda x: x NOT IN (chr(1), chr(2), chr(3)))) >= 4),
total AS (SELECT item_id, count(*) AS n_windows FROM win GROUP BY item_id),
plain AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_folded_sql("coalesce(text, '')")}, '[\\p{{L}}\\p{{M}}]+|\\p{{N}}+(?:[.,:/]\\p{{N}}+)*') AS t FROM documents),
plain_win AS (SELECT item_id, k, list_transform(w, lambda x: {_folded_sql("x")}) AS w FROM win),
hits AS (
  SELECT DISTINCT doc_id, item_id, win.k, TRUE AS own FROM (SELECT doc_id, list_slice(t, p, p + 7) AS w FROM (SELECT doc_id, t, unnest(range(1, len(t) - 6)) AS p FROM docs)) JOIN win USING (w)
  UNION ALL SELECT DISTINCT doc_id, item_id, k, FALSE FROM (SELECT doc_id, list_slice(t, p, p + 7) AS w FROM (SELECT doc_id, t, unnest(range(1, len(t) - 6)) AS p FROM plain)) JOIN plain_win USING (w)),
sums AS (SELECT doc_id, item_id, count(DISTINCT k) FILTER (own) AS own, count(DISTINCT k) AS either, n_windows FROM hits JOIN total USING (item_id) GROUP BY doc_id, item_id, n_windows),
pairs AS (SELECT doc_id, item_id, CASE WHEN own * 100 >= 50 * n_windows THEN own ELSE either END AS covered, n_windows FROM sums WHERE either * 100 >= 50 * n_windows),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY covered / n_windows DESC, item_id) AS r, count(*) OVER (PARTITION BY doc_id) AS n_items FROM pairs)
SELECT d.doc_id, b.doc_id IS NOT NULL AS contaminated, item_id, covered, n_windows, coalesce(n_items, 0) AS n_items
FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND r = 1""",
}
