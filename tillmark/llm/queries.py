"""The dealt operators as queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import (
    decontaminate, exact_dedup, filter_audit, html_extract, lexical_search, licenses, mixing, order_minhash, pii, preference,
    simhash, toxicity, warc)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    manifest = warc.write_archives(warc.record_chunks(pages))
    records = warc.record_table(warc.read_archives(manifest, with_data=False))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("target").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.dedup_decisions(_table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), max_repeats=2.0, keep=["doc_id", "source"])


def op7_preference(spark: SparkSession, folder: str) -> DataFrame:
    turns = preference.answer_pairs(_table(spark, folder, "conversations"))
    return preference.preference_segments(turns)


def op8_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicate_classes(_table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_spans(_table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicate_components(_table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_decontamination": op4_decontamination,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_preference": op7_preference,
    "op8_order_minhash": op8_order_minhash,
    "op9_license_scan": op9_license_scan,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_simhash": op12_simhash,
    "op13_lexical_search": op13_lexical_search,
}

LLM_ORACLE: dict[str, str] = {
    "op3_warc": """
WITH facts AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM facts)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op5_exact_dedup": """
WITH keyed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
           AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)
""",
    "op7_preference": """
WITH turns AS (
  SELECT conv_id, coalesce(turn, -9223372036854775808) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
answers AS (SELECT conv_id, max(turn) AS last FROM turns WHERE role = 'assistant' GROUP BY conv_id),
paired AS (
  SELECT own.conv_id, own.last, other.conv_id AS other_id, other.last AS other_last
  FROM answers own JOIN answers other ON other.conv_id = xor(own.conv_id::BIGINT, 1::BIGINT)),
sides AS (
  SELECT conv_id AS pair_id, TRUE AS chosen, turn, role, text FROM turns JOIN paired USING (conv_id) WHERE turn <= last
  UNION ALL
  SELECT conv_id, FALSE, turn, role, text FROM turns JOIN paired USING (conv_id)
  WHERE turn <= last AND NOT (turn = last AND role = 'assistant')
  UNION ALL
  SELECT paired.conv_id, FALSE, last, role, text
  FROM paired JOIN turns ON turns.conv_id = other_id AND turn = other_last AND role = 'assistant'),
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY pair_id, chosen ORDER BY turn) - 1 AS place FROM sides),
counted AS (
  SELECT pair_id, place, role, text, count(*) FILTER (chosen) AS chosen, count(*) FILTER (NOT chosen) AS rejected
  FROM numbered GROUP BY ALL),
parting AS (SELECT pair_id, min(place) AS parting FROM counted WHERE chosen <> rejected GROUP BY pair_id),
placed AS (SELECT counted.*, parting IS NULL OR place < parting AS shared FROM counted LEFT JOIN parting USING (pair_id)),
uses AS (
  SELECT pair_id, 'prompt' AS part, place, role, text, chosen AS n_rows FROM placed WHERE shared
  UNION ALL SELECT pair_id, 'chosen', place, role, text, chosen FROM placed WHERE NOT shared AND chosen > 0
  UNION ALL SELECT pair_id, 'rejected', place, role, text, rejected FROM placed WHERE NOT shared AND rejected > 0),
rendered AS (
  SELECT *, '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head, replace(text, '<|', '< |') || '<|im_end|>' AS body
  FROM uses)
SELECT pair_id, part, place, role, head || body || chr(10) AS rendered, n_rows, length(head) AS train_from,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) + length(body) ELSE length(head) END AS train_to
FROM rendered
""",
    "op11_filter_audit": r"""
WITH RECURSIVE facts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN facts.doc_id > first_id THEN 'E' ELSE '' END AS failed
  FROM facts LEFT JOIN marks ON facts.doc_id = marks.doc_id),
counted AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM fails GROUP BY part, failed),
orders AS (
  SELECT '' AS o UNION ALL SELECT o || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t(l) WHERE NOT contains(o, l)),
steps AS (SELECT o AS filter_order, s::INT AS step, o[1:s - 1] AS before, o[s] AS letter FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
judged AS (
  SELECT *, contains(failed, letter) AS hit, regexp_matches(failed, '[' || before || '0]') AS gone
  FROM counted, steps),
summed AS (
  SELECT part, filter_order, step, letter, sum(n) FILTER (NOT gone AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
         sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (failed = letter) AS unique_fails,
         sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(bad) FILTER (hit AND NOT gone) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM summed
""",
    "op13_lexical_search": r"""
WITH doc_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY doc_id, term),
item_terms AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM doc_terms GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM item_terms JOIN doc_terms USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
""",
}
