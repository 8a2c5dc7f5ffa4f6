"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import annhash, bpe, contextmix, dialogue, fingerprint, jaccard, langid, mixing, orcstore, periodic, pii, sitetree, warc
from postsieve.llm.common import table
from postsieve.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_bpe")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_pii")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query("op3_lm_score")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    scored = contextmix.score_documents(docs, ~held_out)
    return scored.withColumn("held_out", held_out)


@query("op4_fingerprint")
def op4(spark, sf_dir):
    found = fingerprint.compare_edits(table(spark, sf_dir, "documents"))
    return found.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


@query("op5_langid")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    bucket = langid.bucket_of("doc_id", 4)
    model = langid.train(docs, bucket != 2)
    held_out = docs.withColumn("held_out", F.coalesce(bucket == 2, F.lit(False)))
    return langid.identify(held_out, model, carry=["doc_id", "held_out"])


@query("op6_orc_tokens")
def op6(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    docs = orcstore.in_order(table(spark, sf_dir, "documents"))
    tokens = orcstore.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    orcstore.write_tokens(tokens, path)
    return orcstore.document_starts(spark, path)


@query("op7_jaccard")
def op7(spark, sf_dir):
    return jaccard.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query("op8_ann")
def op8(spark, sf_dir):
    return annhash.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


MIX_SQL = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents),
sized AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % 4096 AS bucket FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         CASE place % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END AS k FROM sources),
leveled AS (
  SELECT *, row_number() OVER (ORDER BY most / w, place) AS nth,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
          - coalesce(sum(most) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, source_size, k,
         least(most, coalesce((SELECT level FROM leveled WHERE level <= most / w ORDER BY nth LIMIT 1) * w, most)) AS target FROM leveled),
placed AS (
  SELECT s.doc_id, s.size, s.h, t.source_size, t.target, t.k,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.bucket, s.h, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS c
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
chosen AS (
  SELECT *, (c + size / 2 < target OR size = 0)::INT AS first_copy, (c + source_size + size / 2 < target)::INT AS second_copy FROM placed)
SELECT doc_id, size, source_size, target, (size * (first_copy + second_copy))::BIGINT AS taken,
       CASE WHEN first_copy = 1 THEN CASE WHEN target > 0
            THEN 2.0::DOUBLE * (c / target) / ((1.0::DOUBLE - k) + sqrt((1.0::DOUBLE - k) * (1.0::DOUBLE - k) + 4.0::DOUBLE * k * (c / target)))
            ELSE 0 END END AS position
FROM chosen
"""


@query("op9_mixing", MIX_SQL)
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.mix_sources(docs)
    return plan.orderBy(mixing.spread_order(), "_mix.h").select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken", "_mix.position")


@query("op10_main_text")
def op10(spark, sf_dir):
    return sitetree.extract(table(spark, sf_dir, "pages"))


WARC_SQL = """
WITH sized AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
held AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
       CASE WHEN h.first IS NOT NULL AND h.first IS DISTINCT FROM s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN h.first IS DISTINCT FROM s.page_id THEN h.first END AS refers_to
FROM sized s LEFT JOIN held h USING (payload_digest)
"""


@query("op11_warc", WARC_SQL)
def op11(spark, sf_dir):
    whole, split = scratch_path(spark, "warc"), scratch_path(spark, "warc-members")
    warc.write_archives(table(spark, sf_dir, "pages"), whole)
    found = warc.read_records(warc.normalise(spark, whole, split))
    digest = F.coalesce(F.sha2("payload", 256), "payload_digest")
    size = F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes")
    return found.select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


@query("op12_runs")
def op12(spark, sf_dir):
    docs = periodic.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.collapse_runs(docs).withColumn("best", periodic.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_conversations")
def op13(spark, sf_dir):
    return dialogue.repair(dialogue.damaged(table(spark, sf_dir, "conversations")), texts=False)
