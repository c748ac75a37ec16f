"""The registered queries: each operator on its whole table, with the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import (
    conversation_repair,
    curriculum,
    decontaminate,
    html_wrappers,
    license_scan,
    line_dedup,
    ngram_join,
    pii,
    quality_gbt,
    quality_rules,
    sharding,
    suffix_dedup,
    whitening,
)
from hazeline.llm.oracle import ORACLE
from hazeline.llm.store import table

__all__ = ["ORACLE", "REGISTRY"]

REGISTRY = {}


def register(run):
    REGISTRY[run.__name__] = run
    return run


@register
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.assign_shards(docs.select("doc_id", "source", "n_chars")).select(
        "doc_id", "source", "n_chars", "slot", "shard"
    )


@register
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = curriculum.mix(table(spark, sf_dir, "documents")).drop("row", "positions")
    return found.withColumn("target", F.round("target", 6)).withColumn("position", F.round("position", 3))


@register
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    spans = F.transform("spans", lambda s: s["label"])
    cover = F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, spans)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.round(cover, 6)).alias("score"),
    )


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


@register
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_gbt.classify(docs, labels)
    return found.select("doc_id", quality_gbt.held_out().alias("held_out"), "score", "predicted")


@register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.digests(docs, line_dedup.keep_bitmaps(docs))


@register
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[
            F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == F.lit(kind)), False)).cast("long").alias(f"n_{kind}")
            for kind in pii.BASE
        ],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


@register
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.link_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@register
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.digests(docs, suffix_dedup.repeated_spans(docs))


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@register
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))
