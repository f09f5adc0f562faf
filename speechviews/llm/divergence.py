"""Source divergence audit: how far each source's terms are from those of the other sources, and of the whole, of its language.

Texts are cut into terms and counted in batches, so only partial counts are shuffled. Kept terms get a number inside a chunk of
their language's vocabulary, and a group's counts become sorted arrays of (number, share), one per chunk. Every unordered pair
of groups co-groups its two arrays of a chunk: a galloping search finds the terms of both, each term is priced in both
directions, and terms that neither has are a multiplication at the end. An array holds a chunk's terms at most, however large
its group, and the prices of chunks add up.

All arithmetic is on whole numbers: shares are parts of a thousand million, by long division where a product would not fit.
Null texts, languages and sources count as empty; a group without terms is compared all the same. A document in the table twice
counts twice. A text of any length is read in pieces. An empty table gives no rows; a language without kept terms has zeros.
Only the three columns are looked at.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from speechviews.llm.common import bare, stored
from speechviews.session import broadcast_if_small

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCUMENTS = 3
PARTS = 1_000_000_000
TERMS_SHOWN = 200

PIECE = 1 << 20  # bytes of a text cut at a time
HELD = 400_000  # counts a task holds before it sends them on
DOCUMENT = 1 << 40  # a document with a term, on top of its occurrences
SEEN = 1 << 22  # documents, and times 64 kB of text, counted before that, so that the two stay apart in 63 bits
CHUNK = 16_384  # terms of a language in an array, about

COUNTS = "lang string, source string, term string, n long, docs long"


def _pieces(text: bytes):
    at = 0
    while at < len(text):
        end = at + PIECE
        rest = TERM.match(text, end)
        end = rest.end() if rest else end
        yield text[at:end]
        at = end


def _counted(batches):
    names = [f.split()[0] for f in COUNTS.split(", ")]
    held, size, seen = {}, 0, 0  # by group: occurrences by term, and the documents on top of them as multiples of DOCUMENT

    def sent():
        sizes = [len(n) for n in held.values()]
        groups = np.repeat(np.arange(len(held)), sizes)
        groups = pa.array(np.concatenate([groups, np.arange(len(held))]))  # and a row of no term for each
        terms = pa.array([t for n in held.values() for t in n] + [None] * len(held), pa.binary()).cast(pa.string())
        packed = np.array([k for n in held.values() for k in n.values()] + [0] * len(held), np.int64)
        langs, sources = (pa.array([g[k] for g in held], pa.string()).take(groups) for k in (0, 1))
        return pa.RecordBatch.from_arrays([langs, sources, terms, pa.array(packed % DOCUMENT), pa.array(packed // DOCUMENT)], names=names)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, value in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            text = value.as_py() or b""
            n = held.setdefault((lang, source), {})
            before, get = len(n), n.get
            own = Counter()
            for piece in _pieces(text):
                own.update(TERM.findall(piece.lower()))
            for term, count in own.items():
                n[term] = get(term, 0) + count + DOCUMENT
            size, seen = size + len(n) - before, seen + 1 + (len(text) >> 16)
            if size >= HELD or seen >= SEEN:
                yield sent()
                held, size, seen = {}, 0, 0
    yield sent()


def counts(docs: DataFrame) -> DataFrame:
    """Written counts by (``lang``, ``source``, ``term``): occurrences ``n`` and ``docs``; every group also has a row of a null term."""
    rows = bare(docs, "text", "lang", "source").na.fill("")
    key = ["lang", "source", "term"]
    partial = rows.mapInArrow(_counted, COUNTS).repartition(*key)  # added up in the tasks already: once more before the exchange would only cost
    return stored(partial.groupBy(key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")


def _share(count, total, kinds):
    """1 + floor(PARTS * (count + 1) / (total + kinds)), three digits at a time."""
    whole, rest, share = total + kinds, count + 1, F.lit(0)
    for _ in range(3):
        share = share * 1000 + F.call_function("div", rest * 1000, whole)
        rest = rest * 1000 % whole
    return share + 1


def _gap(p, q):
    return F.call_function("div", (p - q) * (p - q), q)


def _gaps(p, q):
    return (p - q) ** 2 // q


def galloped(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short`` the first place in ``long`` not below it; both ascend.

    From the place of the first of its run of 32, a number doubles its step until it has passed, then halves the last step.
    """
    low = np.repeat(np.searchsorted(long, short[::32]), 32)[: len(short)]
    high, step = low.copy(), 1
    moving = np.flatnonzero(high < len(long))
    while len(moving):
        moving = moving[long[high[moving]] < short[moving]]
        low[moving] = high[moving] + 1
        high[moving] = np.minimum(high[moving] + step, len(long))
        moving, step = moving[high[moving] < len(long)], 2 * step
    while (open_ := low < high).any():
        middle = (low + high) // 2
        below = open_ & (long[np.minimum(middle, len(long) - 1)] < short)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def _priced(left: pa.Table, right: pa.Table) -> pa.Table:
    """One pair and chunk: both directions of the terms that either has, and how many these are."""
    key = (left if left.num_rows else right).select(["lang", "a", "b", "none_a", "none_b"]).to_pylist()[0]
    sides = []
    for side in (left, right):
        empty = np.zeros(0, np.int64)
        sides.append(tuple(side[c].combine_chunks().values.to_numpy().astype(np.int64) if side.num_rows else empty for c in ("ids", "shares")))
    (ids_a, p_a), (ids_b, p_b) = sides
    none_a, none_b = np.int64(key["none_a"]), np.int64(key["none_b"])
    swap = len(ids_a) > len(ids_b)
    short, long = (ids_b, ids_a) if swap else (ids_a, ids_b)
    at = galloped(short, long)
    common = np.flatnonzero(at < len(long))
    common = common[long[at[common]] == short[common]]
    in_a, in_b = (at[common], common) if swap else (common, at[common])
    alone_a, alone_b = np.delete(p_a, in_a), np.delete(p_b, in_b)
    both_a, both_b = p_a[in_a], p_b[in_b]
    forth = _gaps(both_a, both_b).sum() + _gaps(alone_a, none_b).sum() + _gaps(none_a, alone_b).sum()
    back = _gaps(both_b, both_a).sum() + _gaps(none_b, alone_a).sum() + _gaps(alone_b, none_a).sum()
    return pa.table({
        "lang": [key["lang"]], "a": [key["a"]], "b": [key["b"]], "terms": pa.array([len(ids_a) + len(ids_b) - len(common)], pa.int64()),
        "forth": pa.array([int(forth)], pa.int64()), "back": pa.array([int(back)], pa.int64()),
    })


def audited(docs: DataFrame, shown: int = TERMS_SHOWN) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` and ``rank``, largest value first."""
    counted = counts(docs)
    terms = counted.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    terms = stored(terms.where(F.col("docs") >= LEAST_DOCUMENTS).select("lang", "term", "lang_n"), "vocabulary")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    chunks = max(1, -(-(langs.agg(F.max("kinds")).first()[0] or 0) // CHUNK))
    placed = terms.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int"))
    numbers = placed.withColumn("id", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")))
    kept = stored(counted.join(numbers, ["lang", "term"]).drop("docs"), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.na.fill(0), "groups")
    return _pairs(kept, groups).unionByName(_terms(kept, groups, shown))


def _ranked(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.withColumn("rank", nth)
    rows = rows.where(F.col("rank") <= limit) if limit else rows
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(kept: DataFrame, groups: DataFrame, shown: int) -> DataFrame:
    small, _ = broadcast_if_small(groups.withColumn("key", F.concat("lang", "source")).select("key", *groups.columns))
    rows = kept.join(small.drop("key"), ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("kinds")), _share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    return _ranked(rows.withColumn("value", _gap(F.col("p"), F.col("q"))), "term", shown)


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    shared = groups.withColumn("none", F.when(F.col("kinds") > 0, _share(F.lit(0), F.col("total"), F.col("kinds"))).otherwise(F.lit(1)))
    a = shared.select("lang", F.col("source").alias("a"), F.col("none").alias("none_a"), "kinds")
    b = shared.select("lang", F.col("source").alias("b"), F.col("none").alias("none_b"))
    pairs = stored(a.join(b, "lang").where("a < b"), "group-pairs")
    sizes, _ = broadcast_if_small(groups.withColumn("key", F.concat("lang", "source")).select("key", *groups.columns))
    share = _share(F.col("n"), F.col("total"), F.col("kinds")).cast("int")  # at most PARTS + 1
    entries = kept.join(sizes.drop("key"), ["lang", "source"]).select("lang", "source", "chunk", F.struct("id", share.alias("share")).alias("e"))
    arrays = entries.groupBy("lang", "source", "chunk").agg(F.sort_array(F.collect_list("e")).alias("e"))
    arrays = stored(arrays.select("lang", "source", "chunk", F.col("e.id").alias("ids"), F.col("e.share").alias("shares")), "term-arrays")
    small, _ = broadcast_if_small(pairs.withColumn("key", F.concat("lang", "a", "b")).select("key", *pairs.columns))
    tasks = ["lang", "a", "b", "chunk"]
    columns = [*tasks, "none_a", "none_b", "ids", "shares"]
    left = arrays.withColumnRenamed("source", "a").join(small, ["lang", "a"]).select(columns)
    right = arrays.withColumnRenamed("source", "b").join(small, ["lang", "b"]).select(*[F.col(c).alias(c) for c in columns])
    priced = left.groupBy(tasks).cogroup(right.groupBy(tasks)).applyInArrow(_priced, "lang string, a string, b string, terms long, forth long, back long")
    sums = stored(priced.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("terms", "forth", "back")]), "pair-sums")
    rows = pairs.join(sums, ["lang", "a", "b"], "left").na.fill(0)
    absent, none_a, none_b = F.col("kinds") - F.col("terms"), F.col("none_a"), F.col("none_b")
    forth = rows.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), (F.col("forth") + absent * _gap(none_a, none_b)).alias("value"))
    back = rows.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), (F.col("back") + absent * _gap(none_b, none_a)).alias("value"))
    return _ranked(forth.unionByName(back), "pair")


#: The same in DuckDB, every group with every kept term.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurrences AS (SELECT rid, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, count(*) AS kinds, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n, l.kinds, l.lang_total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups AS g JOIN kept AS k USING (lang) JOIN langs AS l USING (lang) LEFT JOIN counted AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (total + kinds)::HUGEINT AS p, 1 + 1000000000::HUGEINT * (lang_n + 1) // (lang_total + kinds)::HUGEINT AS q
  FROM dense
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups AS g JOIN groups AS h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs AS p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 200
"""
