"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

A text is a bag of passages of ``PASSAGE`` words. A passage is described by how often one class of character follows
another and by how much its words repeat; a layer learned from the labels encodes it. Gated attention weighs the
passages of a bag, and the weighted sum is scored. Only the label of the whole document is used, so the weights
learn which passages speak for it. Language, source and id are no inputs.

Fitted in numpy on at most ``TRAIN_DOCS`` labelled documents of at most ``TRAIN_PASSAGES`` passages, those of the smallest
hashes; every document is scored, whole. Null and empty texts are a bag of one passage without words. Null ids are
scored and never held out or trained on. Labels that are null or contradict each other for one id are not used.
Repeated rows score alike; an empty table gives no rows; without labels of both kinds every score is 0.5.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speechviews.llm.common import fit_sample, stored

PASSAGE, BLOCK = 64, 512
TRAIN_DOCS, TRAIN_PASSAGES = 4000, 400
EPOCHS, BATCH, RATE = 30, 128, 0.01
ENCODED, ATTENTION = 16, 8
THRESHOLD = 0.7

_KINDS = 9  # blank, newline, lower, upper, digit, full stop or comma, exclamation, other ASCII, beyond ASCII
_KIND = np.full(256, 7, np.int64)
_KIND[[32, 9, 11, 12, 13]] = 0
_KIND[10] = 1
_KIND[97:123] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[[44, 46]] = 5
_KIND[33] = 6
_KIND[128:] = 8
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
FEATURES = _KINDS * _KINDS + 2
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def passages(text: bytes) -> np.ndarray:
    """One row of features for each passage; long texts are read in blocks of passages."""
    data = np.frombuffer(text, np.uint8)
    blank = _BLANK[data]
    starts = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0]
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    step = PASSAGE * BLOCK
    edges = [0, *starts[step::step], len(data)]
    return np.concatenate([_features(data[a:b], blank[a:b], starts[k * step:(k + 1) * step] - a, data[b:b + 1])
                           for k, (a, b) in enumerate(zip(edges, edges[1:]))])


def _features(data, blank, starts, following) -> np.ndarray:
    """Features of the passages in a piece of text that ``following``, a character or none, comes after."""
    n = -(-len(starts) // PASSAGE)
    kind = _KIND[np.concatenate([data, following])]
    pair = np.zeros(len(data), np.int64)
    pair[: len(kind) - 1] = kind[:-1] * _KINDS + kind[1:]
    own = np.zeros(len(data), np.int64)
    own[starts[PASSAGE::PASSAGE]] = 1
    own = np.cumsum(own)
    counts = np.bincount(own * (_KINDS * _KINDS) + pair, minlength=n * _KINDS * _KINDS).reshape(n, -1)
    out = np.empty((n, FEATURES), np.float32)
    out[:, :-2] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    in_word = _offsets(starts, len(data))
    letters = np.where(blank, 0, data).astype(np.uint64) * _POWER[in_word & 63]
    words = np.add.reduceat(letters, starts)
    home = np.arange(len(words)) // PASSAGE
    size = np.bincount(home, minlength=n)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (home[1:] == home[:-1])
    mixed = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    in_passage = (mixed ^ (mixed >> np.uint64(32))) + home.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    different = np.bincount(home[np.unique(in_passage, return_index=True)[1]], minlength=n)
    out[:, -2] = np.bincount(home, weights=again, minlength=n) / size
    out[:, -1] = 1 - different / size
    return out


def _offsets(starts, length):
    head = np.zeros(starts[0], np.int64)
    return np.concatenate([head, np.arange(starts[0], length) - np.repeat(starts, np.diff(np.append(starts, length)))])


def initial(rng) -> dict:
    n = lambda *shape: rng.normal(0, 0.3, shape)
    return {"w": n(FEATURES, ENCODED), "b": np.zeros(ENCODED), "v": n(ENCODED, ATTENTION), "u": n(ENCODED, ATTENTION),
            "a": n(ATTENTION), "c": n(ENCODED), "d": np.zeros(1)}


def forward(p, x, first):
    """Scores of bags; ``first`` has the row where each begins."""
    sizes = np.diff(np.append(first, len(x)))
    bag = np.repeat(np.arange(len(first)), sizes)
    h = np.tanh(x @ p["w"] + p["b"])
    tanh, gate = np.tanh(h @ p["v"]), 0.5 * (np.tanh(0.5 * (h @ p["u"])) + 1)
    s = (tanh * gate) @ p["a"]
    e = np.exp(s - np.maximum.reduceat(s, first)[bag])
    weight = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(weight[:, None] * h, first)
    score = 0.5 * (np.tanh(0.5 * (z @ p["c"] + p["d"][0])) + 1)
    return score, (bag, h, tanh, gate, weight, z)


def gradients(p, x, first, y, cost):
    score, (bag, h, tanh, gate, weight, z) = forward(p, x, first)
    dl = (score - y) * cost / len(y)
    dz = dl[:, None] * p["c"]
    dweight = (dz[bag] * h).sum(1)
    ds = weight * (dweight - np.add.reduceat(weight * dweight, first)[bag])
    dpre_v = ds[:, None] * p["a"] * gate * (1 - tanh**2)
    dpre_u = ds[:, None] * p["a"] * tanh * gate * (1 - gate)
    dh = weight[:, None] * dz[bag] + dpre_v @ p["v"].T + dpre_u @ p["u"].T
    dx = dh * (1 - h**2)
    return {"w": x.T @ dx, "b": dx.sum(0), "v": h.T @ dpre_v, "u": h.T @ dpre_u, "a": (tanh * gate).T @ ds, "c": z.T @ dl, "d": dl.sum(keepdims=True)}


def trained(bags: list[np.ndarray], labels: list[int], seed: int = 1) -> dict | None:
    """Parameters fitted by Adam, both labels weighing the same; None unless there are both."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    p = initial(rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at:at + BATCH]
            x = np.concatenate([bags[i] for i in pick])
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])[:-1]])
            step += 1
            for k, g in gradients(p, x, first, y[pick], cost[pick]).items():
                g = g + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return {k: a.astype(np.float32) for k, a in p.items()}


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_bags(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> tuple[list[np.ndarray], list[int]]:
    """Features and labels of at most ``limit`` documents that are not held out."""
    clear = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
    chosen = fit_sample(stored(clear.where("q = q2").where(~held_out()).select("doc_id", "q"), "quality-labels"), limit, "doc_id")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = [passages(t or b"") for t in texts]
            rows = [r.tobytes() if len(r) <= TRAIN_PASSAGES else None for r in rows]
            yield pa.record_batch([batch.column("doc_id"), batch.column("q"), pa.array(rows, pa.binary())], ["doc_id", "q", "bag"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.mapInArrow(run, "doc_id long, q int, bag binary").where("bag is not null")
    rows = sorted(rows.groupBy("doc_id", "q").agg(F.min("bag").alias("bag")).collect(), key=lambda r: r.doc_id)
    return [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in rows], [r.q for r in rows]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, top_weight`` of every row."""
    p = trained(*training_bags(docs, labels))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            score, n, top = np.full(len(texts), 0.5), np.empty(len(texts), np.int64), np.empty(len(texts))
            for at in range(0, len(texts), 256):
                bags = [passages(t or b"") for t in texts[at:at + 256]]
                sizes = np.array([len(b) for b in bags])
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                n[at:at + 256], top[at:at + 256] = sizes, 1 / sizes
                if p:
                    got, kept = forward(p, np.concatenate(bags), first)
                    score[at:at + 256], top[at:at + 256] = got, np.maximum.reduceat(kept[4], first)
            yield pa.record_batch([batch.column("doc_id"), pa.array(score), pa.array(n), pa.array(top)], ["doc_id", "score", "n_passages", "top_weight"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_passages long, top_weight double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "top_weight")
