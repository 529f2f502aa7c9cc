"""The registered corpus queries, each on its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    chat, classifier, decontaminate, html_text, importance, licenses, line_rules, negatives, packing, ring, secrets, simhash, sql,
    url_templates)
from daybook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The other operators are beyond SQL or its speed on whole tables; their tests hold brute-force versions.
SQL: dict[str, str] = {
    "op1_license_scans": sql.LICENSES,
    "op4_chat_formatting": sql.CHAT,
    "op8_quality_rules": sql.RULES,
    "op11_ring_sharding": sql.SHARDS,
    "op12_importance_resampling": sql.IMPORTANCE,
    "op13_hard_negatives": sql.NEGATIVES,
}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    def of_kind(kind: int) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{secrets.KINDS[kind]}")

    base, counts = F.filter("spans", lambda span: span["kind"] < 3), [of_kind(kind) for kind in range(3)]
    return secrets.scan(table(spark, folder, "documents")).select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    ours = spark.sql("""
        SELECT bigint(-1) AS conv_id, bigint(turn) AS turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    return chat.digests(chat.format_chats(turns.unionByName(ours)))


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.judge(table(spark, folder, "documents")).drop("host", "mark", "shared")


@query
def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op11_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return ring.places(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.weights(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))
