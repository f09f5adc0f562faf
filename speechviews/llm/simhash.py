"""SimHash near-duplicates: generalised pigeonhole search over fingerprints, exact up to the bit distance.

The 64 bits are dealt into partitions so that bits that go together share one. Partition i gets a threshold t_i with
sum(t_i + 1) = distance + 1 (-1: not probed); two fingerprints within the distance then agree up to t_i bits in
some partition. The thresholds come from dynamic programming over estimated candidates, whose bit statistics cover
all fingerprints. Probes are joined and verified on all bits inside the join, so only links leave it. Equal
fingerprints are one node. A bucket of more than ``HEAVY`` different fingerprints is not joined with itself: its members
meet at shared neighbours (at most ``distance // 2`` bits from one, the rest from the other), which costs a
fixed number of rows each and links them through one hub.

Nulls: a null text is empty, an empty text has fingerprint zero and is linked like any other. A null id never names a
component unless all its rows have null ids. Repeated rows and ties get the same class. An empty table gives no rows.
"""

import math
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from speechviews.llm.common import components, numbered, stored, whole_row

SEED = 42
BITS = 64
HEAVY = 4096
BLOCK = 1 << 16  # shingles of a long text that are hashed at once


def fingerprint(text: bytes, shingle: int) -> int:
    """The simhash of the text's word shingles; ASCII letters are lower-cased, repeats count."""
    words = text.lower().split()
    if not words:
        return 0
    rows = zip(*(islice(words, i, None) for i in range(shingle))) if len(words) >= shingle else iter([words])
    join, digest, n, set_ = b" ".join, xxhash.xxh64_intdigest, 0, np.zeros(BITS, np.int64)
    while len(hashes := np.array([digest(join(row), SEED) for row in islice(rows, BLOCK)], dtype=">u8")):
        set_ += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * set_ > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, text_key, fp`` for every row."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), pa.array(fps)], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How often bits i and j are set together, over all rows; 64 x 64."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(values), 4096):
                bits = ((values[i:i + 4096, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += bits.T @ bits
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel().astype(np.int64))], ["i", "j", "n"])

    together = np.zeros((BITS, BITS))
    for row in fps.mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        together[row.i, row.j] = row.n
    return together


def plan(together: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """Partitions of the bits with thresholds, cheapest by estimated probes and candidates: ``[(bits, threshold)]``."""
    n = max(n, 2)
    p = together / n
    own = np.diag(p)
    spread = np.sqrt(np.clip(np.outer(own * (1 - own), own * (1 - own)), 1e-12, None))
    tied = np.abs(p - np.outer(own, own)) / spread
    both = p**2 + (own[:, None] - p) ** 2 + (own[None, :] - p) ** 2 + (1 - own[:, None] - own[None, :] + p) ** 2
    agree = np.clip(own**2 + (1 - own) ** 2, 1e-6, 1 - 1e-6)
    best = None
    for parts in range(1, distance + 2):
        groups = _grouped(tied, parts)
        costs = [_costs(g, agree, both, n, distance) for g in groups]
        table = {0: (0.0, [])}
        for cost in costs:
            following = {}
            for spent, (total, taken) in table.items():
                for t in range(-1, distance - spent + 1):
                    found = (total + (cost[t] if t >= 0 else 0.0), [*taken, t])
                    if spent + t + 1 not in following or found[0] < following[spent + t + 1][0]:
                        following[spent + t + 1] = found
            table = following
        total, thresholds = table[distance + 1]
        if best is None or total < best[0]:
            best = (total, [(g, t) for g, t in zip(groups, thresholds) if t >= 0])
    return best[1]


def _grouped(tied: np.ndarray, parts: int) -> list[list[int]]:
    """Equal groups; each grows from a free bit by the bit most tied to it."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        group = [min(free)]
        free.discard(group[0])
        while len(group) < width:
            nearest = max(sorted(free), key=lambda b: tied[b, group].sum())
            group.append(nearest)
            free.discard(nearest)
        groups.append(group)
    return groups


def _costs(group, agree, both, n, distance) -> list[float]:
    """By threshold: probes plus pairs of fingerprints that differ in so many bits of the group at most."""
    same = math.log(agree[group[0]]) + sum(math.log(max(both[a, b], 1e-9) / agree[a]) for a, b in zip(group, group[1:]))
    ways = [1.0] + [0.0] * distance
    for b in group:
        odds = (1 - agree[b]) / agree[b]
        for k in range(distance, 0, -1):
            ways[k] += ways[k - 1] * odds
    pairs = n * n / 2 * math.exp(min(0.0, same))
    return [20 * n * sum(math.comb(len(group), k) for k in range(t + 1)) + pairs * sum(ways[: t + 1]) for t in range(distance + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _flips(bits, most: int, least: int = 0) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for k in range(least, most + 1) for c in combinations(bits, k)]


def _array(values):
    return F.expr(f"array({', '.join(f'{v}L' if v != -(1 << 63) else 'shiftleft(1L, 63)' for v in values)})")


def links(nodes: DataFrame, distance: int, parts, heavy: int = HEAVY) -> DataFrame:
    """``(a, b)`` such that fingerprints within the distance are connected, and no others are linked."""
    exact, probes = [], []
    for k, (bits, threshold) in enumerate(parts):
        key = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        exact.append(nodes.select(F.lit(k).alias("part"), key.alias("key"), F.col("fp").alias("a")))
        flips = F.explode(_array(_flips(bits, threshold))) if threshold else F.lit(0).cast("long")
        probes.append(nodes.select("fp", key.alias("base"), flips.alias("flip")).select(
            F.lit(k).alias("part"), F.col("base").bitwiseXOR(F.col("flip")).alias("key"), F.col("fp").alias("b")))
    exact, probes = _union(exact), _union(probes)
    large = stored(exact.groupBy("part", "key").count().where(F.col("count") > heavy).select("part", "key"), "heavy-buckets")
    many = not large.isEmpty()
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    small = exact.join(large, ["part", "key"], "left_anti") if many else exact
    found = small.join(probes, (small.part == probes.part) & (small.key == probes.key) & (F.col("a") < F.col("b")) & near)
    found = found.select("a", "b")
    if many:
        members = exact.join(large, ["part", "key"]).select(F.col("a").alias("fp"))
        members = members.unionByName(probes.join(large, ["part", "key"]).select(F.col("b").alias("fp"))).distinct()
        found = found.unionByName(met_at_neighbours(members, distance))
    return found.distinct()


def met_at_neighbours(nodes: DataFrame, distance: int) -> DataFrame:
    """Links through shared neighbours: a key within ``distance // 2`` bits of a hub and within the rest of its members.

    A key has at most as many members as there are fingerprints that near to it, so no list grows with the data.
    """
    near = distance // 2
    close = nodes.select("fp", F.explode(_array(_flips(range(BITS), near))).alias("flip"), F.lit(True).alias("close"))
    far = nodes.select("fp", F.explode(_array(_flips(range(BITS), distance - near, near + 1))).alias("flip"), F.lit(False).alias("close"))
    keys = close.unionByName(far).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "close")
    met = keys.groupBy("key").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"), F.collect_list("fp").alias("members"))
    stars = met.where("hub is not null and size(members) > 1").select("hub", F.explode("members").alias("fp")).where("hub <> fp")
    return stars.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, text_key, fp, component_id`` for every row; the component's name is its smallest id."""
    rows = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-nodes")
    together = bit_counts(nodes)
    parts = plan(together, nodes.count(), distance)
    roots = components(links(nodes.select("fp"), distance, parts, heavy)).withColumnRenamed("node", "fp")
    classes = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    names = classes.join(named, "root").select("fp", "root", "component_id")
    return rows.join(names, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null last; columns unchanged."""
    rows = near_duplicates(docs, shingle, distance)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = rows.groupBy("root").agg(F.min(key).alias("k")).select(F.col("k.doc_id").alias("id_"), F.col("k.text_key").alias("key_"))
    whole = docs.select("doc_id", "text", whole_row(docs))
    first = numbered(whole).where("nth = 1").select("doc_id", "text_key", "whole")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & F.col("text_key").eqNullSafe(F.col("key_"))
    return first.join(kept, same, "left_semi").select("whole.*")
