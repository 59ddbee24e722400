"""The queries of this subpackage, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import chat, decontaminate, lines, media, mixing, neardup, pii, pivots, quality, repair, secrets, sql, urls, whitening
from pairloom.session import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.collapse_snapshots(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "n_turns", "n_copies", "rendered")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["order"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(r.kind) for r in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    secret = spark.conf.get("spark.pairloom.pii.key", "a key for trials only")
    return pii.pseudonymise_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), secret.encode())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = media.media_columns(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pairs = F.transform(F.arrays_zip("times", "hashes"), lambda p: F.concat_ws(":", p["times"].cast("string"), p["hashes"].cast("string")))
    feature = F.concat_ws(",", F.col("n_frames").cast("string"), F.size("times").cast("string"), F.md5(F.array_join(pairs, ",")))
    return made.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"), "times", "hashes")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = made.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("z").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("at")].alias("explained"), "identity_error")


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.linked_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_chat_formatting, op2_secret_scan, op3_decontamination, op4_line_dedup, op5_pii, op6_mixing, op7_quality, op8_url_filter, op9_near_dedup, op10_media, op11_conversation_repair, op12_whitening, op13_embedding_near_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
