"""Removal of repeated passages by prefix-partitioned suffix trees over words.

Every word position with ``WINDOW`` words to its right begins a suffix. Suffixes are split into memory-sized groups by
prefixes of variable length: a count of all prefixes of ``HEAD`` words, in bins, packs light bins together and splits heavy
ones by the words that follow. A group's tree is built as sorted suffixes with the lengths that neighbours share; an
internal node of depth ``WINDOW`` or more is a repeat, and all its suffixes but the first in the corpus are repeated
windows. A word covered by a repeated window goes.

What keeps the exchange small and groups bounded, without leaving a repeat out:
- copies of a whole text are found by their digest: every window of a copy starts earlier, so a copy needs no suffixes;
- a repeated window has its smallest ``GRAM``-word run (by hash) repeated too, so only windows whose smallest run
  occurs twice in the corpus become suffixes;
- documents meet in buckets of about ``BUCKET_BYTES``; of equal windows in a bucket the first alone is sent on, so a passage
  that a third of all documents share costs one suffix a bucket.

Prefixes are compared by 64-bit hashes of their first 8 and next 12 words. Nulls: a null text has no words. Rows with the same id
and text are one document and get the same result; rows with the same id and other texts come in the order of a hash
of their texts, null ids after all others. Empty and short texts lose nothing; an empty table gives no rows.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

WINDOW, HEAD, GRAM = 20, 8, 5
BUCKET_BYTES = 4 << 20
GROUP_ROWS = 250_000
BIN_BITS = 16
CHUNK_BYTES = 2 << 20
LAST = (1 << 63) - 1  # stands for a null id, after all others
_M = 0x9E3779B97F4A7C15
_TOP = np.uint64((1 << 64) - 1)


def _later(a: np.ndarray, k: int, fill=0) -> np.ndarray:
    """``a`` shifted left by k; the end is filled."""
    out = np.full_like(a, fill)
    if k < len(a):
        out[: len(a) - k] = a[k:]
    return out


def _run(a: np.ndarray, k: int, b: np.ndarray) -> np.ndarray:
    """Hashes of runs: k words by ``a``, followed by the words of ``b``."""
    return a + np.uint64(pow(_M, k, 1 << 64)) * _later(b, k)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts in one row of hashes, with what is known of each position."""

    def __init__(self, texts: list[bytes]):
        self.words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        digest = xxhash.xxh3_64_intdigest
        h = np.fromiter((digest(w) for words in self.words for w in words), np.uint64, int(self.sizes.sum()))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        self.left = np.repeat(self.first + self.sizes, self.sizes) - np.arange(len(h))  # words from here to the end
        two = _run(h, 1, h)
        four = _run(two, 2, two)
        eight = _run(four, 4, four)
        self.head = _scrambled(eight)
        self.tail = _scrambled(_later(_run(eight, 8, four), HEAD))
        self.gram = _scrambled(_run(four, 4, h))
        self.gram[self.left < GRAM] = _TOP
        self.starts = self.left >= WINDOW

    def smallest(self, values=None) -> np.ndarray:
        """The smallest run's hash of the window at each position."""
        v, reach = (self.gram if values is None else values), 1
        while reach < WINDOW - GRAM + 1:
            step = min(reach, WINDOW - GRAM + 1 - reach)
            v = np.minimum(v, _later(v, step, _TOP))
            reach += step
        return v

    def anchors(self) -> np.ndarray:
        """Whether a position's run is the smallest of some window."""
        v, reach, width = np.where(self.starts, self.smallest(), 0), 1, WINDOW - GRAM + 1
        while reach < width:
            step = min(reach, width - reach)
            shifted = np.zeros_like(v)
            shifted[step:] = v[: len(v) - step] if step < len(v) else 0
            v = np.maximum(v, shifted)
            reach += step
        return (v == self.gram) & (self.left >= GRAM)

    def repeated_here(self, at: np.ndarray) -> np.ndarray:
        """Which of the windows at ``at`` (in order) equal an earlier one of them."""
        order = np.lexsort((at, self.tail[at], self.head[at]))
        return deep_repeats(self.head[at][order], self.tail[at][order])[np.argsort(order, kind="stable")]


def deep_repeats(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Of sorted suffixes, those under a node of depth ``WINDOW`` that are not its first.

    Neighbours share 0, ``HEAD`` or ``WINDOW`` words; the edge to a node of that depth ends where they share less.
    """
    shared = np.zeros(len(head), np.int64)
    same = head[1:] == head[:-1]
    shared[1:] = np.where(same, np.where(tail[1:] == tail[:-1], WINDOW, HEAD), 0)
    return shared >= WINDOW


def _chunks(texts: list[bytes]):
    """Slices of about ``CHUNK_BYTES``."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_BYTES:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def prefix_counts(rows: DataFrame) -> np.ndarray:
    """How many suffixes fall into each bin of the first ``HEAD`` words' hash; ``2 ** BIN_BITS`` numbers."""

    def run(batches):
        total = np.zeros(1 << BIN_BITS, np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in _chunks(texts):
                w = Words(texts[a:b])
                total += np.bincount((w.head[w.starts] >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS)
        bins = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(bins), pa.array(total[bins])], ["bin", "n"])

    counts = np.zeros(1 << BIN_BITS, np.int64)
    for r in rows.select("text").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[r.bin] = r.n
    return counts


def prefix_groups(counts: np.ndarray, rows: int = GROUP_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Each bin's first group, and into how many groups its longer prefixes are split."""
    split = np.maximum(1, -(-counts // rows))
    first, at, filled = np.zeros(len(counts), np.int64), 0, 0
    for k, n in enumerate(counts):
        if split[k] > 1 or filled + n > rows:
            at, filled = at + (filled > 0), 0
        first[k] = at
        if split[k] > 1:
            at += int(split[k])
        else:
            filled += int(n)
    return first, split


def documents_with_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, sub, text``: the order of documents is that of (doc, sub)."""
    ids = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    clear = ids.where("doc_id is null or a <> b").isEmpty()
    sub = F.lit(0).cast("long") if clear else F.xxhash64("text")
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), sub.alias("sub"), "text")


ORACLE = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM texts WHERE len(words) >= {WINDOW}) AS s),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows) AS r WHERE nth > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM repeated) AS g GROUP BY doc_id)
SELECT t.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda word, p: NOT list_contains(coalesce(places, []), p)), ' ')) AS kept_sha256
FROM texts t LEFT JOIN gone ON gone.doc_id = t.doc_id"""


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every row; ``kept`` has the words that stay, joined by blanks."""
    rows = documents_with_keys(docs.select("doc_id", "text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("doc", "sub", F.lit(5)), F.lit(-(-total // BUCKET_BYTES) or 1)).alias("bucket")
    rows = rows.select(bucket, "doc", "sub", "doc_id", "text")
    first_group, split = prefix_groups(prefix_counts(rows))

    def pack(batches):
        for batch in batches:
            press = zstandard.ZstdCompressor(level=3)
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            packed = pa.array([press.compress(t or b"") for t in texts], pa.binary())
            yield pa.record_batch([*batch.columns[:4], packed], ["bucket", "doc", "sub", "doc_id", "packed"])

    def smallest_runs(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            buckets = batch.column("bucket").to_numpy()
            for a, b in _chunks(texts):
                w = Words(texts[a:b])
                at = np.nonzero(w.anchors())[0]
                h, home = w.gram[at], buckets[a:b][w.text[at]]
                order = np.lexsort((h, home))
                h, home = h[order], home[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (home[1:] != home[:-1])
                n = np.diff(np.append(np.nonzero(new)[0], len(h)))
                yield pa.record_batch([pa.array(home[new]), pa.array(h[new].view(np.int64)), pa.array(n)], ["bucket", "h", "n"])

    def sorted_words(table, drop):
        """The texts of a bucket in order, without those in ``drop``."""
        table = table.sort_by([("doc", "ascending"), ("sub", "ascending")])
        doc, sub = table.column("doc").to_numpy(), table.column("sub").to_numpy()
        keep = [k for k in range(len(doc)) if (doc[k], sub[k]) not in drop and (k == 0 or (doc[k], sub[k]) != (doc[k - 1], sub[k - 1]))]
        unpack = zstandard.ZstdDecompressor().decompress
        packed = table.column("packed")
        return doc[keep], sub[keep], Words([unpack(packed[k].as_py()) for k in keep])

    def suffixes(table, side):
        copy = pc.is_null(side.column("h"))
        copies = side.filter(copy)
        doc, sub, w = sorted_words(table, set(zip(copies.column("doc").to_pylist(), copies.column("sub").to_pylist())))
        twice = np.unique(side.filter(pc.invert(copy)).column("h").to_numpy().view(np.uint64))
        least = w.smallest()
        if len(twice):
            found = twice[np.minimum(np.searchsorted(twice, least), len(twice) - 1)] == least
        else:
            found = np.zeros(len(least), bool)
        at = np.nonzero(w.starts & found)[0]
        at = at[~w.repeated_here(at)]
        bins = (w.head[at] >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        group = first_group[bins] + (w.tail[at] % split[bins].astype(np.uint64)).astype(np.int64)
        home = np.full(len(at), table.column("bucket")[0].as_py() if table.num_rows else 0)
        return pa.table({
            "group": group, "head": w.head[at].view(np.int64), "tail": w.tail[at].view(np.int64), "bucket": home,
            "doc": doc[w.text[at]], "sub": sub[w.text[at]], "pos": (at - w.first[w.text[at]]).astype(np.int32),
        })

    def tree(table):
        c = {n: table.column(n).to_numpy() for n in table.column_names}
        order = np.lexsort((c["pos"], c["sub"], c["doc"], c["tail"], c["head"]))
        at = order[deep_repeats(c["head"][order], c["tail"][order])]
        at = at[np.lexsort((c["pos"][at], c["doc"][at], c["bucket"][at]))]
        return pa.table({n: c[n][at] for n in ("bucket", "doc", "sub", "pos")})

    def kept(table, side):
        whole = pc.is_null(side.column("pos"))
        copies = side.filter(whole)
        copies = set(zip(copies.column("doc").to_pylist(), copies.column("sub").to_pylist()))
        doc, sub, w = sorted_words(table, copies)
        cover = np.zeros(len(w.left) + 1, np.int64)
        at = np.nonzero(w.starts)[0]
        at = [at[w.repeated_here(at)]]
        place = {key: k for k, key in enumerate(zip(doc.tolist(), sub.tolist()))}
        other = side.filter(pc.invert(whole))
        if other.num_rows:
            text = np.array([place[key] for key in zip(other.column("doc").to_pylist(), other.column("sub").to_pylist())])
            at.append(w.first[text] + other.column("pos").to_numpy())
        at = np.unique(np.concatenate(at)).astype(np.int64)
        cover[at] += 1
        np.subtract.at(cover, at + WINDOW, 1)
        gone = np.cumsum(cover)[:-1] > 0
        unpack = zstandard.ZstdDecompressor().decompress
        out = []
        for d, s, i, packed in zip(*(table.column(n).to_pylist() for n in ("doc", "sub", "doc_id", "packed"))):
            if (d, s) in copies:
                words = unpack(packed).split()
                stay = [] if len(words) >= WINDOW else words
            else:
                k = place[d, s]
                words = w.words[k]
                mask = gone[w.first[k]:w.first[k] + w.sizes[k]]
                stay = [x for x, g in zip(words, mask) if not g] if mask.any() else words
            text = b" ".join(stay)
            out.append((i, len(words), len(words) - len(stay), sha256(text).hexdigest(), text))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table({n: pa.array([r[k] for r in out], kind) for k, (n, kind) in enumerate(zip(names, kinds))})

    packed = rows.mapInArrow(pack, "bucket long, doc long, sub long, doc_id long, packed binary")
    runs = rows.select("bucket", "text").mapInArrow(smallest_runs, "bucket long, h long, n long")
    twice = runs.groupBy("h").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("h")
    nothing = F.lit(None)
    twice = runs.join(twice, "h").select("bucket", "h", nothing.cast("long").alias("doc"), nothing.cast("long").alias("sub"))
    keys = rows.select("bucket", "doc", "sub", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    first = keys.groupBy("digest").agg(F.min(F.struct("doc", "sub")).alias("f"))
    copies = keys.join(first, "digest").where("doc <> f.doc or sub <> f.sub").select("bucket", "doc", "sub")
    side = twice.unionByName(copies.withColumn("h", nothing.cast("long")))
    sent = packed.groupBy("bucket").cogroup(side.groupBy("bucket")).applyInArrow(
        suffixes, "group long, head long, tail long, bucket long, doc long, sub long, pos int")
    marked = sent.groupBy("group").applyInArrow(tree, "bucket long, doc long, sub long, pos int")
    marked = marked.unionByName(copies.withColumn("pos", nothing.cast("int")))
    return packed.groupBy("bucket").cogroup(marked.groupBy("bucket")).applyInArrow(
        kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
