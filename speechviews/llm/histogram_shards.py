"""Sharding by histogram sort: probe key boundaries with exact byte counts, refine, exchange once.

The sort key is a hash of the text followed by a hash of ``doc_id``, so equal texts are neighbours. A splitter is a
prefix of that key. Each round counts the bytes below all candidate prefixes of the open intervals in one
aggregation; the intervals that hold no good boundary are divided further. The driver sees at most
``(shards - 1) * 2 ** BITS`` sums a round. Equal texts are separated only if a splitter falls into a group of
more than ``GROUP_SHARE`` of a shard.

Nulls: a null text has no bytes, a null id is hashed as such. Rows that agree in id and text have one key and stay
together. An empty table gives no rows; with fewer rows than shards some shards stay empty. Added columns replace
input columns of the same name.
"""

import itertools

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from speechviews.llm.common import stored, text_or_empty, whole_row

BITS = 10
DEPTH = 60  # bits used of either hash
TOLERANCE = 0.002
GROUP_SHARE = 0.01
SLICE_ROWS = 50_000
RECORD_BYTES = 8


def keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.withColumns({
        "size": F.octet_length(text).cast("long") + RECORD_BYTES,
        "key_text": F.shiftrightunsigned(F.xxhash64(text), 64 - DEPTH),
        "key_id": F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(1)), 64 - DEPTH),
    })


def _prefix(bits: int):
    """The first bits of the key as one number, or as the remaining part of one that begins with the text's."""
    if bits <= DEPTH:
        return F.shiftright("key_text", DEPTH - bits)
    return F.shiftright("key_id", 2 * DEPTH - bits)


def _inside(bits: int, value: tuple):
    """Whether a key begins with the prefix ``value``: (text part, id part)."""
    if bits <= DEPTH:
        return _prefix(bits) == value[0]
    return (F.col("key_text") == value[0]) & (_prefix(bits) == value[1])


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, tuple]]:
    """``shards - 1`` prefixes (bits, value); a key at or above the k-th belongs to a later shard than k."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    ideal = total / shards
    start = {"bits": 0, "value": (0, 0), "below": 0}
    open_ = {k: dict(start) for k in range(1, shards)}
    found = {}
    for bits in range(BITS, 2 * DEPTH + 1, BITS):
        if not open_:
            break
        values = {o["value"] for o in open_.values()}
        rows = keys
        if bits > BITS:
            inside = [_inside(bits - BITS, v) for v in sorted(values)]
            rows = keys.where(_any(inside))
        parts = [F.col("key_text").alias("head") if bits > DEPTH else F.lit(0).cast("long").alias("head"), _prefix(bits).alias("bin")]
        counts = (
            rows.select(*parts, "size", "key_text").groupBy("head", "bin")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("key_text").alias("lo"), F.max("key_text").alias("hi"))
            .orderBy("head", "bin").collect()
        )
        for k, o in list(open_.items()):
            goal, below = k * ideal, o["below"]
            own = [r for r in counts if _parent(r, bits) == o["value"]]
            for r in own:
                if below + r.bytes < goal:
                    below += r.bytes
                    continue
                here = (r.bin, 0) if bits <= DEPTH else (r.head, r.bin)
                after = (r.bin + 1, 0) if bits <= DEPTH else (r.head, r.bin + 1)
                low_miss, high_miss = goal - below, below + r.bytes - goal
                small_group = r.lo == r.hi and r.bytes <= GROUP_SHARE * ideal
                if min(low_miss, high_miss) <= tolerance * ideal or r.n == 1 or small_group or bits == 2 * DEPTH:
                    found[k] = (bits, here if low_miss <= high_miss else after)
                    del open_[k]
                else:
                    o |= {"value": here, "below": below}
                break
            else:
                found[k] = (bits, (1 << DEPTH, 0))
                del open_[k]
    return [found[k] for k in sorted(found)]


def _any(conditions):
    return list(itertools.accumulate(conditions, lambda a, b: a | b))[-1]


def _parent(row, bits):
    if bits <= DEPTH:
        return (row.bin >> BITS, 0)
    return (row.head, row.bin >> BITS) if bits > DEPTH + BITS else (row.head, 0)


def _at_or_above(bits: int, value: tuple):
    if bits <= DEPTH:
        return _prefix(bits) >= value[0]
    return (F.col("key_text") > value[0]) | ((F.col("key_text") == value[0]) & (_prefix(bits) >= value[1]))


def write_shards(docs: DataFrame, path: str, shards: int = 24, tolerance: float = TOLERANCE):
    """The documents in a folder of files for each shard; a shard's slices are written side by side."""
    shard_documents(docs, shards, tolerance).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (0 to ``shards - 1``, near equal bytes) and ``slot`` (gapless in each shard).

    Only ids and hashes are stored for probing. The rows are exchanged once, by shard and slice; the slices of a shard
    are numbered side by side, so a shard is never in one task.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("size", "shard", "slot")])
    placed = keyed(docs.select("doc_id", "text", whole_row(docs))).select("whole", "size", "key_text", "key_id")
    keys = stored(placed.select("key_text", "key_id", "size"), "shard-keys")
    cuts = [_at_or_above(*s).cast("int") for s in splitters(keys, shards, tolerance)]
    shard = list(itertools.accumulate(cuts, lambda a, b: a + b))[-1] if cuts else F.lit(0)
    slices = max(1, -(-keys.count() // (shards * SLICE_ROWS)))
    marked = {"shard": shard, "slice": F.pmod(F.col("key_id"), F.lit(slices)).cast("int")}
    sizes = keys.withColumns(marked).groupBy("shard", "slice").count()
    starts = sizes.select("shard", "slice", (F.sum("count").over(Window.partitionBy("shard").orderBy("slice")) - F.col("count")).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("key_text", "key_id"))
    ranked = placed.withColumns(marked).withColumn("nth_in_slice", nth)
    return ranked.join(starts, ["shard", "slice"]).withColumn("slot", F.col("start") + F.col("nth_in_slice") - 1).select(
        "whole.*", "size", "shard", "slot"
    )
