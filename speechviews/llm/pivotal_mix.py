"""Mixing sources to target weights by pivotal dependent rounding of copy probabilities.

A source that should contribute ``f`` times its words gives every document ``floor(f)`` copies and a further one with
the fractional probability. Two documents of a source are paired: words move from one to the other, in a direction
drawn so that expectations hold, until one of them has a whole copy or none; the other goes on. Documents are paired in
bounded chunks, the one left of each chunk meets the others' on the next level: a reduction tree. The sum of
words stays constant at every step, so a source misses its target by less than one document. Draws hash the rows,
hence reruns agree.

Nulls: a null text has size 0, a null source is a source of its own and comes last, null ids are rows like others.
Empty texts take no words; their further copy is drawn alone. Rows that agree in id and text are drawn separately.
An empty table gives no rows.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from speechviews.llm.common import WORD, numbered, stored, text_or_empty, unit_interval, whole_row

WEIGHTS = (5, 2, 1)
MOST = 3
CHUNK = 64
ROW = ("doc_id", "text_key", "nth")


def sizes_of(docs: DataFrame) -> DataFrame:
    """One row per document without its text: id, source, size in words."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("text_key"),
                      F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))
    return cut.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("source")))


def targets(sizes: DataFrame, weights=WEIGHTS, most=MOST) -> DataFrame:
    """``source, source_size, n, target``: shares by weight of the source's rank, none above ``most`` times its size.

    What a capped source cannot take raises the level of all others until no target is above its cap.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(sources.withColumn("weight", weight), "mix-sources")
    cap, level = most * F.col("source_size"), 0.0
    while True:
        capped = cap < F.col("weight") * level
        total, fixed, free = sources.agg(
            F.sum("source_size"), F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        reached = (total - fixed) / free if free else level
        if reached <= level:
            break
        level = reached
    return sources.select("source", "source_size", "n", F.least(F.col("weight") * level, cap.cast("double")).alias("target"))


def _paired(carry, other):
    """The carried row against the next one: (settled row with its copy, the row that goes on)."""
    up = F.least(carry["size"] - carry["words"], other["words"])
    down = F.least(carry["words"], other["size"] - other["words"])
    rises = unit_interval(carry["draw"], other["draw"], F.lit(7)) * (up + down) < down
    carry_settles = F.when(rises, carry["size"] - carry["words"] <= other["words"]).otherwise(
        carry["words"] <= other["size"] - other["words"]
    )
    settled = F.when(carry_settles, _row(carry, rises)).otherwise(_row(other, ~rises))
    goes_on = F.when(
        carry_settles, other.withField("words", F.when(rises, other["words"] - up).otherwise(other["words"] + down))
    ).otherwise(carry.withField("words", F.when(rises, carry["words"] + up).otherwise(carry["words"] - down)))
    return settled, goes_on


def _row(item, copied):
    return F.struct(*[item[c].alias(c) for c in ROW], copied.cast("int").alias("extra"))


def _merged(state, item):
    settled, goes_on = _paired(state["carry"], item)
    return F.struct(goes_on.alias("carry"), F.concat(state["done"], F.array(settled)).alias("done"))


def rounded(items: DataFrame) -> DataFrame:
    """``(doc_id, text_key, nth, extra)`` for items ``(group, doc_id, text_key, nth, size, words, draw)``; size is over 0."""
    done, level = [], 0
    item = F.struct("draw", *ROW, "size", "words")
    while True:
        counts = items.groupBy("group").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
        chunked = items.join(counts.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g"))).withColumn(
            "chunk", F.pmod(F.xxhash64("draw", F.lit(level)), F.col("chunks"))
        )
        lists = chunked.groupBy("group", "chunk").agg(F.sort_array(F.collect_list(item)).alias("all"))
        first = F.col("all")[0]
        none = F.array().cast("array<struct<doc_id:bigint,text_key:bigint,nth:int,extra:int>>")
        tree = F.aggregate(F.expr("slice(all, 2, size(all))"), F.struct(first.alias("carry"), none.alias("done")), _merged)
        out = stored(lists.select("group", tree.alias("tree")), "mix-level")
        done.append(out.select(F.explode("tree.done").alias("row")).select("row.*"))
        items = out.select("group", "tree.carry.*")
        if items.groupBy("group").count().where("count > 1").isEmpty():
            break
        level += 1
    last = items.select(*ROW, (unit_interval("draw", F.lit(11)) * F.col("size") < F.col("words")).cast("int").alias("extra"))
    for part in done:
        last = last.unionByName(part)
    return last


def copies(docs: DataFrame, weights=WEIGHTS, most=MOST) -> DataFrame:
    """Every row's ``doc_id, text_key, nth, size, source_size, target, copies``."""
    sizes = stored(sizes_of(docs), "mix-sizes")
    goals = targets(sizes, weights, most).withColumn("share", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    goals = goals.select(F.col("source").alias("s"), "source_size", "target", F.floor("share").alias("whole"), (F.col("share") - F.floor("share")).alias("part"))
    rows = sizes.join(goals, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("draw", F.xxhash64(*ROW, F.lit(3)))
    open_ = rows.where("size > 0 and part > 0").select(
        F.col("source").alias("group"), *ROW, F.col("size").cast("double").alias("size"), (F.col("size") * F.col("part")).alias("words"), "draw"
    )
    extra = rounded(open_).select(*[F.col(c).alias(f"{c}_") for c in ROW], "extra")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ROW]
    alone = F.when((F.col("size") == 0) & (unit_interval("draw", F.lit(11)) < F.col("part")), 1).otherwise(0)
    return rows.join(extra, same, "left").select(
        *ROW, "size", "source_size", "target", (F.col("whole") + F.coalesce("extra", alone)).cast("int").alias("copies")
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most=MOST) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; columns unchanged."""
    rows = numbered(docs.select("doc_id", "text", "source", whole_row(docs)), "source").select(*ROW, "whole")
    plan = copies(docs, weights, most).where("copies > 0").select(*[F.col(c).alias(f"{c}_") for c in ROW], "copies")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ROW]
    return rows.join(plan, same).select("whole", F.explode(F.expr("array_repeat(0, copies)"))).select("whole.*")
