"""The operators as named queries over the whole tables, with production parameters, and the SQL where there is one."""

from pyspark.sql import functions as F

from speechviews.llm import (
    divergence, histogram_shards, license_digest, merkle, mil_quality, pii, pitman_yor, pivotal_mix, robust_rules, simhash, suffix_dedup, templates, url_rules,
)
from speechviews.llm.common import bare, documents, text_or_empty

QUERIES, ORACLES = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pii_tagger(spark, folder):
    rows = pii.found(bare(documents(spark, folder), "doc_id", "text"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op2_mil_quality(spark, folder):
    return mil_quality.scored(bare(documents(spark, folder), "doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op3_histogram_shards(spark, folder):
    docs = bare(documents(spark, folder), "doc_id", "text").withColumn("text_crc32", F.crc32(text_or_empty()))
    return histogram_shards.shard_documents(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_license_digests(spark, folder):
    return license_digest.scanned(bare(documents(spark, folder), "doc_id", "text"))


ORACLES["op4_license_digests"] = license_digest.ORACLE


@query
def op5_suffix_trees(spark, folder):
    return suffix_dedup.without_repeats(bare(documents(spark, folder), "doc_id", "text")).drop("kept")


ORACLES["op5_suffix_trees"] = suffix_dedup.ORACLE


@query
def op6_pitman_yor(spark, folder):
    return pitman_yor.scored(bare(documents(spark, folder), "doc_id", "text"))


@query
def op7_simhash_components(spark, folder):
    rows = simhash.near_duplicates(bare(documents(spark, folder), "doc_id", "text"), shingle=3, distance=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_pivotal_mix(spark, folder):
    rows = pivotal_mix.copies(bare(documents(spark, folder), "doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op9_robust_rules(spark, folder):
    rows = robust_rules.judged(bare(documents(spark, folder), "doc_id", "text", "lang", "source"))
    counts = [F.col(f"rule_counts.{c}").alias(c) for c in robust_rules.COUNTS]
    return rows.select("doc_id", *counts, "base_failed", "kept", "distance2")


@query
def op10_template_decontamination(spark, folder):
    rows = templates.flagged(bare(documents(spark, folder), "doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return rows.withColumn("items", F.array_join("items", ","))


ORACLES["op10_template_decontamination"] = templates.ORACLE


@query
def op11_merkle_manifest(spark, folder):
    return merkle.audited(documents(spark, folder))


ORACLES["op11_merkle_manifest"] = merkle.ORACLE


@query
def op12_url_rules(spark, folder):
    pages = bare(spark.read.parquet(f"{folder}/pages.parquet"), "page_id", "url").withColumn("page_id", F.col("page_id").cast("long"))
    return url_rules.judged(pages).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op12_url_rules"] = url_rules.ORACLE


@query
def op13_source_divergence(spark, folder):
    return divergence.audited(documents(spark, folder))


ORACLES["op13_source_divergence"] = divergence.ORACLE
