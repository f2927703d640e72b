"""The opN queries of this subpackage; their DuckDB SQL is in sql.py."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, licenses, lm_score, mixing, neardup, pu_quality, quality_rules, resample, sharding, token_counts, url_filter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.in_training_order(mixing.mix(docs).drop("text"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "copies", F.get("positions", F.lit(0)).alias("position"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return decontam.contaminated(docs, items)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return pu_quality.classify(docs, labels).drop("text")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).drop("text")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row", "key")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"))
    return warc.parse(warc.read(archive))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as captures, dated within one year by their page_id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")))


def list_entries(captures: DataFrame) -> DataFrame:
    """A year's log of three lists over the hosts of the captures.

    The first four hex digits h of md5(host) decide what happens to a host:
    'ads' blocks a third of the hosts from day h % 200 and releases half of
    these 60 days later; 'malware' blocks the domain without its first label
    for a seventh of them from day h % 300; 'adult' blocks the folder /en/ of
    a fifth of them from day h % 100, and lifts and renews that on two days.
    """
    host = url_filter.host_of(F.col("url"))
    hosts = captures.select(host.alias("host")).filter("host <> ''").distinct().withColumn("h", F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int"))

    def entry(name, kind, value, active, day):
        return F.struct(F.lit(name).alias("list"), F.lit(kind).alias("kind"), value.alias("value"), F.lit(active).alias("active"), F.date_add(F.lit("2024-01-01").cast("date"), day).alias("at"))

    h, domain, folder = F.col("h"), F.regexp_replace("host", r"^[^.]*\.", ""), F.concat("host", F.lit("/en/"))
    entries = F.array(
        F.when(h % 3 == 0, entry("ads", "host", F.col("host"), True, h % 200)),
        F.when(h % 6 == 0, entry("ads", "host", F.col("host"), False, h % 200 + 60)),
        F.when(h % 7 == 0, entry("malware", "domain", domain, True, h % 300)),
        F.when(h % 5 == 0, entry("adult", "path", folder, True, h % 100)),
        F.when(h % 5 == 0, entry("adult", "path", folder, False, h % 100 + 90)),
        F.when(h % 5 == 0, entry("adult", "path", folder, True, h % 100 + 150)),
    )
    return hosts.select(F.explode(F.array_compact(entries)).alias("e")).select("e.*")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = captures(spark, sf_dir)
    return url_filter.url_filter(pages, list_entries(pages)).drop("url").withColumn("fetched_at", F.col("fetched_at").cast("string"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, labels).drop("text")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "benchmark")).drop("row")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def builders() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_decontamination, op3_licenses, op4_quality, op5_lm_score, op6_sharding, op7_near_duplicates, op8_warc, op9_url_filters, op10_quality_rules, op11_resampling, op12_token_counts, op13_centroids)}
