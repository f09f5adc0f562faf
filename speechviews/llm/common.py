"""Helpers shared by the operators: words, stored tables, row identity, connected components."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from speechviews.session import scratch_path

#: A word is a run of characters other than blank, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: a cut of the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column="text"):
    return F.coalesce(F.col(column), F.lit(""))


def unit_interval(*columns):
    """A number in [0, 1) that depends on the columns' values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def fit_sample(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most ``limit`` rows to fit a model on, those of the smallest hashes of the keys.

    Half as many again pass a threshold on the hash, set by the number of rows, before they are put in
    order; so what is sent on does not grow with the data. ``rows`` should be a written table.
    """
    share = 1.5 * limit / max(rows.count(), 1)
    return rows.where(unit_interval(*keys) < share).orderBy(F.xxhash64(*keys), *keys).limit(limit)


def numbered(docs: DataFrame, order: str = "text_key") -> DataFrame:
    """``docs`` with ``text_key`` and ``nth``, which with ``doc_id`` name a row.

    Rows that agree in ``doc_id`` and text, null ids included, are interchangeable and get nth 1, 2, ...
    """
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    return keyed.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy(order)))


def whole_row(docs: DataFrame):
    """All columns as one struct ``whole``, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")


def bare(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone; a missing one is null. Other columns cannot clash with an operator's own."""
    kinds = {n: "bigint" if n == "doc_id" else "string" for n in names}
    return docs.select(*[(F.col(n) if n in docs.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node it is connected with.

    Large-star and small-star rounds alternate until no edge changes. A star is reduced to its minimum before
    it is joined, so a hub costs one row per neighbour and adaptive execution may split it. No edges: no rows.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
