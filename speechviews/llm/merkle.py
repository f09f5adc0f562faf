"""Merkle manifest of a dataset: one tree per group over its rows in order, one tree over the groups' roots.

A level is a window: ``lag`` and ``lead`` by fixed offsets, masked by the node's slot and by the length of its run,
give a node its siblings, and the first child of a run hashes the parent. All levels of a block of ``arity ** LEVELS``
nodes share one partitioning and one order, so a block costs one exchange, whatever its depth; only the blocks' roots go on
to the next pass. Blocks are a few thousand rows, so a group that holds most of the data is many tasks. Places are
counted by one range exchange: rows are written in order, and what the earlier files hold is added.

Nulls: a null field is hashed as ``-``; null groups and null ids come first. Rows of one id are put in order by their
leaves; rows that agree in everything are interchangeable. A text of any length is hashed where it is read and goes no
further. An empty table has no leaves and no root. Only the named columns count; others of any name are not looked at.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from speechviews.llm.common import bare, stored
from speechviews.session import broadcast_if_small

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
BLOCK = 4096  # rows of a window's partition, rounded down to a power of the arity
SLICE_ROWS = 200_000

OWN = ["group", "id", "leaf"]


def canonical(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value, so that joined fields cannot be confused."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[canonical(c) for c in fields.values()]), 256)


def leaves(docs: DataFrame, fields=FIELDS, group="lang", order="doc_id", **more: Column) -> DataFrame:
    """Written leaves: ``group``, ``id``, ``leaf``, ``at`` (tells equal rows apart) and the expressions of ``more``."""
    kinds = {n: F.col(f"`{n}`") if n in docs.columns else F.lit(None).cast("string") for n in {*fields, group, order}}
    rows = docs.select(
        canonical(kinds[group]).alias("group"), kinds[group].alias("group_value"), kinds[order].alias("id"),
        leaf({n: kinds[n] for n in fields}).alias("leaf"), *[e.alias(n) for n, e in more.items()],
    )
    return stored(rows.withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")


def placed(rows: DataFrame, group: str, *order) -> DataFrame:
    """``rows``, a written table, with ``place`` (from 0, gapless in the group by the given order) and ``nodes`` (rows of the group)."""
    slices = max(1, -(-rows.count() // SLICE_ROWS))
    keys = [F.col(group), *order]
    ranged = rows.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
    ranged = stored(ranged.withColumn("position", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("slice", F.shiftright("position", 33))
    sizes = ranged.groupBy(group, "slice").agg(F.count("*").alias("n"), F.min("position").alias("low"))
    earlier = Window.partitionBy(group).orderBy("slice")
    starts = sizes.select(
        group, "slice", "low", (F.sum("n").over(earlier) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy(group)).alias("nodes")
    )
    starts, _ = broadcast_if_small(starts)
    return ranged.join(starts, [group, "slice"]).withColumn("place", F.col("start") + F.col("position") - F.col("low")).drop("slice", "low", "start", "position")


def climbed(nodes: DataFrame, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """``nodes`` (``group``, ``place``, ``nodes``, ``digest`` and anything else) with ``steps`` and ``top``.

    ``steps`` are the siblings from the node up to its group's root: structs of the digests to the left, joined, and of those to
    the right; ``top`` is that root. Passes: one per ``block`` of height, each on the roots of the one before.
    """
    most = nodes.agg(F.max("nodes")).first()[0] or 1
    levels = 1
    while arity ** (levels + 1) <= block and arity**levels < most:
        levels += 1
    size = arity**levels
    rows = nodes.withColumn("block", F.expr(f"place div {size}"))
    inside = Window.partitionBy("group", "block").orderBy("place")
    for level in range(levels):
        span = arity**level
        rows = _level(rows.withColumn("d0", F.col("digest")) if not level else rows, level, span, arity, inside)
    seen = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = F.array_compact(F.array(*[F.last(f"s{k}", ignorenulls=True).over(seen) for k in range(levels)]))
    top = F.first(f"d{levels}").over(seen)
    rows = rows.select(*nodes.columns, "block", steps.alias("steps"), top.alias("top"))
    if most <= size:
        return rows.drop("block")
    rows = stored(rows, "merkle-blocks")
    roots = rows.where(F.col("place") % size == 0).select(
        "group", F.col("block").alias("place"), F.expr(f"(nodes + {size - 1}) div {size}").alias("nodes"), F.col("top").alias("digest")
    )
    above = climbed(stored(roots, "merkle-roots"), arity, block).select("group", F.col("place").alias("block"), F.col("steps").alias("more"), F.col("top").alias("root"))
    return rows.join(above, ["group", "block"]).select(*nodes.columns, F.concat("steps", "more").alias("steps"), F.col("root").alias("top"))


def _level(rows: DataFrame, level: int, span: int, arity: int, inside) -> DataFrame:
    """Siblings of the nodes of one level, kept at their first rows, and the parents at the first rows of their runs.

    A node's first row is ``span`` rows from that of its neighbour, so the offsets are fixed and the masks do the rest. Where the
    group has one node left, it is handed up as it is.
    """
    digest = F.col(f"d{level}")
    index, count = F.expr(f"place div {span}"), F.expr(f"(nodes + {span - 1}) div {span}")
    slot = index % arity
    run = F.least(F.lit(arity), count - index + slot)
    lefts = [F.when(slot >= j, F.lag(digest, j * span).over(inside)) for j in range(arity - 1, 0, -1)]
    rights = [F.when(slot + j < run, F.lead(digest, j * span).over(inside)) for j in range(1, arity)]
    mine, open_ = F.col("place") % span == 0, count > 1
    rows = rows.withColumns({"l": F.concat_ws("", *lefts), "r": F.concat_ws("", *rights)})
    parent = F.when(open_, F.sha2(F.concat(digest, F.col("r")), 256)).otherwise(digest)
    return rows.withColumns({
        f"s{level}": F.when(mine & open_, F.struct(F.col("l").alias("left"), F.col("r").alias("right"))),
        f"d{level + 1}": F.when(F.col("place") % (span * arity) == 0, parent),
    }).drop("l", "r")


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof(steps: Column) -> Column:
    """All siblings, from the leaf up, left to right."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(leaf_rows: DataFrame, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """The written leaves of ``leaves()`` with ``steps`` up to the root over all groups, ``subroot`` of the group, and ``root``."""
    own = placed(leaf_rows, "group", "id", "leaf", "at").drop("at").withColumn("digest", F.col("leaf"))
    own = stored(climbed(own, arity, block).drop("digest", "nodes").withColumnRenamed("top", "subroot"), "merkle-groups")
    groups = own.where("place = 0").select(F.lit("").alias("tree"), "group", "group_value", "subroot")
    over = placed(stored(groups, "merkle-subroots"), "tree", "group_value").withColumn("digest", F.col("subroot"))
    over = over.withColumnRenamed("group", "of").withColumnRenamed("tree", "group")
    over = climbed(over, arity, block).select(F.col("of").alias("group"), F.col("steps").alias("above"), F.col("top").alias("root"))
    over, _ = broadcast_if_small(stored(over, "merkle-top"), max_rows=10_000)
    return own.join(over, "group").withColumn("steps", F.concat("steps", "above")).drop("above", "group_value")


def differences(docs: DataFrame, old: DataFrame, fields=FIELDS, group="lang", order="doc_id") -> DataFrame:
    """Leaves that a manifest does not prove, or that it has and the documents have not: ``group``, ``id``, ``leaf``, ``added``.

    ``added`` is how many rows the documents have beyond the manifest (negative: fewer). Entries whose siblings do not lead to
    the manifest's root prove nothing.
    """
    now = leaves(docs, fields, group, order).groupBy(OWN).agg(F.count("*").alias("n"))
    then = old.where(folded(F.col("leaf"), F.col("steps")) == F.col("root")).groupBy(OWN).agg((-F.count("*")).alias("n"))
    return now.unionByName(then).groupBy(OWN).agg(F.sum("n").alias("added")).where("added <> 0")


def audited(docs: DataFrame, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """Every document's leaf, proof and roots, and whether a copy whose ``n_chars`` was raised by 1, where 7 divides the id's hash, still verifies."""
    docs = bare(docs, *FIELDS).select(*[F.col(n).cast("decimal(38,0)").alias(n) if n == "n_chars" else F.col(n) for n in FIELDS])
    fields = {n: F.col(n) for n in FIELDS}
    tampered = leaf({**fields, "n_chars": fields["n_chars"] + 1})
    hit = F.crc32(fields["doc_id"].cast("string")) % 7 == 0
    rows = manifest(leaves(docs, presented=F.when(hit, tampered).otherwise(leaf(fields))), arity, block)
    rows = rows.withColumn("folded_root", folded(F.col("presented"), F.col("steps")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof(F.col("steps")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "place",
    )


def _sql_field(name: str, value: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(f, n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


#: The same in DuckDB: trees by recursion, paths by joins of all levels, CRC32 bit by bit.
ORACLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("(n_chars + 1)")} AS tampered,
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295) AS crc
  FROM documents
), numbered AS (
  SELECT *, CASE WHEN crc % 7 = 0 THEN tampered ELSE leaf END AS presented, row_number() OVER () AS rid,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), tree AS (
  SELECT 0 AS level, lang, place, leaf AS digest, n FROM numbered
  UNION ALL
  SELECT level + 1, lang, place // 2, sha256(digest || coalesce(other, '')), (n + 1) // 2
  FROM (SELECT *, lead(digest) OVER (PARTITION BY lang ORDER BY place) AS other FROM tree WHERE n > 1) AS pairs WHERE place % 2 = 0
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), over AS (
  SELECT 0 AS level, place, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(digest || coalesce(other, '')), (n + 1) // 2
  FROM (SELECT *, lead(digest) OVER (ORDER BY place) AS other FROM over WHERE n > 1) AS pairs WHERE place % 2 = 0
), nodes AS (
  SELECT 0 AS part, lang, level, place, digest, n FROM tree
  UNION ALL SELECT 1, s.lang, o.level, o.place, o.digest, o.n FROM over AS o, (SELECT DISTINCT lang FROM subroots) AS s
), own AS (
  SELECT rid, lang, 0 AS part, place FROM numbered
  UNION ALL SELECT rid, m.lang, 1, s.place FROM numbered AS m JOIN subroots AS s ON m.lang IS NOT DISTINCT FROM s.lang
), steps AS (
  SELECT o.rid, o.part, l.level, o.place >> l.level AS index, sibling.place AS other,
    CASE WHEN sibling.place IS NULL THEN 'N' WHEN sibling.place < (o.place >> l.level) THEN 'L' || sibling.digest ELSE 'R' || sibling.digest END AS step
  FROM own AS o
  JOIN (SELECT DISTINCT part, lang, level FROM nodes WHERE n > 1) AS l ON o.part = l.part AND o.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN nodes AS sibling ON sibling.part = l.part AND sibling.level = l.level AND sibling.lang IS NOT DISTINCT FROM l.lang
    AND sibling.place = xor(o.place >> l.level, 1)
), paths AS (SELECT rid, list(step ORDER BY part, level) AS path FROM steps GROUP BY rid),
checked AS (
  SELECT m.doc_id, m.leaf, s.subroot, (SELECT digest FROM over WHERE n = 1) AS root, m.place,
    sha256(coalesce(list_reduce(list_transform(path, lambda s: s[2:]), lambda a, b: a || b, ''), '')) AS proof_sha256,
    coalesce(list_reduce(path, lambda d, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || d WHEN 'R' THEN d || s[2:] ELSE d END), m.presented), m.presented) AS folded_root
  FROM numbered AS m JOIN subroots AS s ON m.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (rid)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified, place FROM checked
"""
