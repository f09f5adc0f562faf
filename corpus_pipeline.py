"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps, whole; the last one adds ``size``, ``shard`` and ``slot``.
Every stage is written as Parquet and read again before the next. Nulls, empty texts, repeated rows, empty tables and
additional columns are treated as the operators' docstrings say.
"""

from pyspark.sql import DataFrame, SparkSession

from speechviews.llm import histogram_shards, pivotal_mix, robust_rules, simhash, templates
from speechviews.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return robust_rules.passing(docs)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, also none with other numbers, names or units."""
    return templates.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return pivotal_mix.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the shard of near equal bytes they go to, and their slot in it."""
    return histogram_shards.shard_documents(docs, 24)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

#: The bits of a simhash, robust distances and random rounding have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
