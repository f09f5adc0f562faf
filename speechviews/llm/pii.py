"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. The tagger is trained in numpy on windows whose labelled spans are base spans, some of
them rewritten (other separators, no plus sign, a spaced or spelled-out at sign) so that it also learns spans
which the patterns miss. It reads overlapping windows; a window is decoded if it holds a digit, an at sign, or
"at" in brackets or blanks before a dotted name, without which no span can be. Spans of all windows of a text are reconciled globally: those cut by a window's edge go, the others
are taken by their score, highest first, unless they overlap a base span or one taken before.

``TRAIN_WINDOWS`` bounds the windows that are fitted on; they are those of the smallest hashes. Nulls: a null text is empty.
Null ids and repeated rows are rows like others. Empty texts have no spans; an empty table gives no rows. A table without
labelled spans gives base spans only.
"""

import itertools
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speechviews.llm.common import fit_sample, stored

KINDS = ("email", "ip", "card", "phone")
#: Base patterns (fixed values).
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same for long runs: an address is looked for from its at sign, and no run of digits is entered twice.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
SCANS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": PATTERNS["phone"],
}
BASE_TRIGGER = r"[0-9@]"
#: What a span of the tagger holds: a digit, an at sign, or one spelled out before a dotted name.
TRIGGER = BASE_TRIGGER + r"|(?<![A-Za-z])[Aa][Tt](?=[\x20\x09-\x0D()\[\]{}<>_-]+[A-Za-z0-9][A-Za-z0-9-]{0,62}\.[A-Za-z0-9])"
WINDOW, STRIDE = 96, 48
TRAIN_WINDOWS, STEPS, BATCH, HIDDEN, RATE = 4000, 400, 64, 16, 0.03
TAGS = 1 + 2 * len(KINDS)
SCORE = 0.9  # least mean probability of a span's tags

_FIXED = {c: k + 8 for k, c in enumerate(".@-+() _%,:/\n=\"")}
CLASSES = 8 + len(_FIXED)
_CLASS = np.zeros(0x3000, np.int64) + 5
for _c in range(128):
    _ch = chr(_c)
    _CLASS[_c] = _FIXED.get(_ch, 1 if _ch.isdigit() else 2 if _ch.islower() else 3 if _ch.isupper() else 4)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Where ``PATTERNS["email"]`` matches: each at sign with what may stand before it, not before the last match's end."""
    out, behind, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        behind = domain.end() if domain else at + 1
        if domain:
            out.append((start, behind))
        at = text.find("@", behind)
    return out


def base_spans(text: str, verified: bool = True) -> list[tuple[int, int, int]]:
    """``(kind's number, start, end)`` by start, then kind; with card numbers that fail the check digit if not ``verified``."""
    out = []
    for k, kind in enumerate(KINDS):
        if kind == "email":
            out += [(start, k, end) for start, end in emails(text)]
            continue
        if kind == "phone" and "+" not in text:
            continue
        for m in SCANS[kind].finditer(text):
            found = m.group()
            digits = re.sub("[^0-9]", "", found)
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or 0) > 255 for p in found.split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and (luhn(digits) or not verified)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return [(k, start, end) for start, k, end in sorted(out)]


def windows_of(text: str, trigger: str = TRIGGER) -> list[int]:
    """Starts of the windows that hold a trigger."""
    starts = set()
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    for m in re.finditer(trigger, text):
        at = m.start() // STRIDE * STRIDE
        starts.update(s for s in (at - STRIDE, at) if 0 <= s <= last)
        if at > last:
            starts.add(last)
    return sorted(starts)


def encoded(texts: list[str]) -> np.ndarray:
    """Character classes of windows, padded with 0."""
    out = np.zeros((len(texts), WINDOW), np.int64)
    for row, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out[row, : len(points)] = _CLASS[np.minimum(points, len(_CLASS) - 1)]
    return out


def _tags(length: int, spans) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for k, start, end in spans:
        tags[start] = 1 + k
        tags[start + 1:end] = 1 + len(KINDS) + k
    return tags


def rewritten(text: str, spans, rng) -> tuple[str, list]:
    """The window with other spellings of its spans."""
    out, moved, at = "", [], 0
    for k, start, end in spans:
        found = text[start:end]
        if KINDS[k] == "email":
            found = found.replace("@", rng.choice([" @ ", "(at)", " (at) ", "@"]))
        elif KINDS[k] == "phone":
            found = re.sub(r"^\+[0-9]{1,3} ?", rng.choice(["", "+1 ", "1-"]), found).replace(" ", rng.choice([" ", "-", "."]))
        elif KINDS[k] == "card":
            found = rng.choice([".", " ", "-"]).join(re.findall("[0-9]{1,4}", re.sub("[^0-9]", "", found)))
        out += text[at:start]
        moved.append((k, len(out), len(out) + len(found)))
        out += found
        at = end
    return (out + text[at:])[:WINDOW], [(k, s, min(e, WINDOW)) for k, s, e in moved if s < WINDOW]


# ---------------------------------------------------------------- model


def initial(rng) -> dict:
    h, scale = HIDDEN, 0.2
    p = {}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, scale, (CLASSES, 4 * h))
        p[f"u{d}"] = rng.normal(0, scale, (h, 4 * h))
        p[f"a{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
    return p | {"v": rng.normal(0, scale, (2 * h, TAGS)), "c": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large negative number; the row TAGS is the start."""
    m = np.zeros((TAGS + 1, TAGS))
    n = len(KINDS)
    for k in range(n):
        m[:, 1 + n + k] = -1e4
        m[[1 + k, 1 + n + k], 1 + n + k] = 0
    return m


ALLOWED = _allowed()


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(x, w, u, a, keep=False):
    """Hidden states (windows, time, HIDDEN) of one direction; what the backward pass needs if kept."""
    n, length, h = len(x), x.shape[1], HIDDEN
    hid, cell, out, saved = np.zeros((n, h)), np.zeros((n, h)), np.empty((n, length, h)), []
    for t in range(length):
        z = w[x[:, t]] + hid @ u + a
        gates, g = _sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h:])
        i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
        before, before_hid = cell, hid
        cell = f * cell + i * g
        tc = np.tanh(cell)
        hid = o * tc
        out[:, t] = hid
        if keep:
            saved.append((i, f, o, g, before, tc, before_hid))
    return out, saved


def _lstm_back(x, u, saved, dout):
    h = HIDDEN
    dw, du, da = np.zeros((CLASSES, 4 * h)), np.zeros_like(u), np.zeros(4 * h)
    dh, dc = np.zeros((len(x), h)), np.zeros((len(x), h))
    for t in range(x.shape[1] - 1, -1, -1):
        i, f, o, g, before, tc, before_hid = saved[t]
        dh = dh + dout[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(dw, x[:, t], dz)
        du += before_hid.T @ dz
        da += dz.sum(0)
        dh, dc = dz @ u.T, dc * f
    return dw, du, da


def emissions(p, x, keep=False):
    forward, kept_f = _lstm(x, p["xf"], p["uf"], p["af"], keep)
    backward, kept_b = _lstm(x[:, ::-1], p["xb"], p["ub"], p["ab"], keep)
    hidden = np.concatenate([forward, backward[:, ::-1]], axis=2)
    return hidden @ p["v"] + p["c"], hidden, kept_f, kept_b


def _sum_exp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(e, moves):
    """Forward and backward log sums over tag paths, and their total."""
    n, length, _ = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0] + ALLOWED[TAGS]
    for t in range(1, length):
        alpha[:, t] = e[:, t] + _sum_exp(alpha[:, t - 1][:, :, None] + moves, 1)
    for t in range(length - 2, -1, -1):
        beta[:, t] = _sum_exp(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    return alpha, beta, _sum_exp(alpha[:, -1], 1)


def best_path(e, moves):
    """Viterbi tags and the probability of each."""
    alpha, beta, total = marginals(e, moves)
    n, length, _ = e.shape
    score, back = e[:, 0] + ALLOWED[TAGS], np.empty((n, length, TAGS), np.int8)
    for t in range(1, length):
        step = score[:, :, None] + moves
        back[:, t] = step.argmax(1)
        score = step.max(1) + e[:, t]
    tags = np.empty((n, length), np.int64)
    tags[:, -1] = score.argmax(1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    at = np.take_along_axis(alpha + beta, tags[:, :, None], 2)[:, :, 0]
    return tags, np.exp(np.minimum(0, at - total[:, None]))


def gradients(p, x, gold):
    e, hidden, kept_f, kept_b = emissions(p, x, True)
    moves = p["t"] + ALLOWED[:TAGS]
    alpha, beta, total = marginals(e, moves)
    n, length, _ = e.shape
    rows = np.arange(n)[:, None]
    de = np.exp(alpha + beta - total[:, None, None])
    de[rows, np.arange(length)[None, :], gold] -= 1
    dt = np.zeros((TAGS, TAGS))
    for t in range(1, length):
        pair = alpha[:, t - 1][:, :, None] + moves + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
        dt += np.exp(pair).sum(0)
        np.add.at(dt, (gold[:, t - 1], gold[:, t]), -1)
    dh = de @ p["v"].T
    g = {"v": np.einsum("nth,ntk->hk", hidden, de), "c": de.sum((0, 1)), "t": dt}
    g["xf"], g["uf"], g["af"] = _lstm_back(x, p["uf"], kept_f, dh[:, :, :HIDDEN])
    g["xb"], g["ub"], g["ab"] = _lstm_back(x[:, ::-1], p["ub"], kept_b, dh[:, ::-1, HIDDEN:])
    return {k: v / n for k, v in g.items()}


def trained(windows: list[tuple[str, list]], steps: int = STEPS, seed: int = 1) -> dict | None:
    """Parameters fitted by Adam on windows with labelled spans; None if no window has a span."""
    rng = np.random.default_rng(seed)
    rows = [(text, spans) for text, spans in windows]
    marked = [r for r in rows if r[1]]
    if not marked:
        return None
    rows += [rewritten(text, spans, rng) for text, spans in marked]
    rows = [r for r in rows if all(s < e <= len(r[0]) for _, s, e in r[1])]
    x = encoded([t for t, _ in rows])
    gold = np.stack([_tags(WINDOW, spans) for _, spans in rows])
    p = initial(rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), min(BATCH, len(x)))
        for k, g in gradients(p, x[pick], gold[pick]).items():
            g = np.clip(g, -5, 5)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return {k: a.astype(np.float32) for k, a in p.items()}


def _plausible(kind: str, found: str) -> bool:
    """What any span of a kind must hold."""
    digits = sum(c.isdigit() for c in found)
    if kind == "email":
        return ("@" in found or "at" in found.lower()) and "." in found
    if kind == "ip":
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= digits <= 19 and luhn(re.sub("[^0-9]", "", found))
    return 10 <= digits <= 15


def tagged_spans(p: dict, texts: list[str], block: int = 2048) -> list[list]:
    """``(score, kind's number, start, end)`` of every text, all windows together; cut spans are left out."""
    where = [(n, s) for n, text in enumerate(texts) for s in windows_of(text)]
    out = [[] for _ in texts]
    moves = p["t"] + ALLOWED[:TAGS]
    n_kinds = len(KINDS)
    for at in range(0, len(where), block):
        part = where[at:at + block]
        tags, sure = best_path(emissions(p, encoded([texts[n][s:s + WINDOW] for n, s in part]))[0], moves)
        for row in np.nonzero(((tags > 0) & (tags <= n_kinds)).any(1))[0]:
            n, s = part[row]
            length = min(WINDOW, len(texts[n]) - s)
            for b in np.nonzero((tags[row, :length] > 0) & (tags[row, :length] <= n_kinds))[0]:
                k, e = int(tags[row, b]) - 1, int(b) + 1
                while e < length and tags[row, e] == 1 + n_kinds + k:
                    e += 1
                cut = b == 0 and s > 0 or e == length and s + length < len(texts[n])
                if not cut:
                    out[n].append((float(sure[row, b:e].mean()), k, s + int(b), s + e))
    return out


def reconciled(text: str, base: list, found: list) -> list:
    """Base spans and those of the tagger that fit beside them, by start, then kind."""
    taken = bytearray(len(text))
    for _, s, e in base:
        taken[s:e] = b"\1" * (e - s)
    out = list(base)
    for score, k, s, e in sorted(found, key=lambda x: (-x[0], x[2], x[1], x[3])):
        if score < SCORE or not re.search(TRIGGER, text[s:e]) or not _plausible(KINDS[k], text[s:e]):
            continue
        if taken.find(1, s, e) < 0:
            taken[s:e] = b"\1" * (e - s)
            out.append((k, s, e))
    return sorted(out, key=lambda x: (x[1], x[0], x[2]))


# ---------------------------------------------------------------- Spark


def training_windows(docs: DataFrame, limit: int = TRAIN_WINDOWS) -> list[tuple[str, list]]:
    """At most ``limit`` windows with the base spans inside them."""

    def run(batches):
        for batch in batches:
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text, verified=False)  # no tagger learns check digits; found cards are verified later
                begins, reach = [a for _, a, _ in base], list(itertools.accumulate((b for _, _, b in base), max))
                for s in windows_of(text, BASE_TRIGGER):  # a spelled-out address has no base span and is no example of none
                    near = [span for span in base[bisect_right(reach, s):bisect_left(begins, s + WINDOW)] if span[2] > s]
                    inside = [(k, a - s, b - s) for k, a, b in near if s <= a and b <= s + WINDOW]
                    if len(near) == len(inside):
                        texts.append(text[s:s + WINDOW])
                        spans.append(" ".join(f"{k}:{a}:{b}" for k, a, b in inside))
            yield pa.record_batch([pa.array(texts, pa.string()), pa.array(spans, pa.string())], ["window", "spans"])

    rows = docs.select("text").where(F.col("text").rlike(BASE_TRIGGER)).mapInArrow(run, "window string, spans string")
    rows = fit_sample(stored(rows.distinct(), "tagger-windows"), limit, "window", "spans").collect()
    return [(r.window, [tuple(map(int, s.split(":"))) for s in r.spans.split()]) for r in rows]


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _spans(texts: list[str], p: dict | None) -> list[tuple[list, list]]:
    """Base spans and all spans of every text."""
    base = [base_spans(t) if t else [] for t in texts]
    more = tagged_spans(p, texts) if p else [[] for _ in texts]
    return [(b, reconciled(t, b, m)) for t, b, m in zip(texts, base, more)]


def redacted(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; all columns stay."""
    p = model if model is not None else trained(training_windows(docs))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for text, (_, spans) in zip(texts, _spans([t or "" for t in texts], p)):
                at, parts = 0, []
                for k, s, e in spans:
                    if s >= at:
                        parts += [text[at:s], f"<{KINDS[k]}>"]
                    at = max(at, e)
                out.append("".join([*parts, text[at:]]) if spans else text)
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def found(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``doc_id``, counts of base spans by kind, ``base`` and ``spans`` as ``kind:start:end`` lists, for every row.

    The tagger is trained on the table itself unless ``model`` is given; its weights are a few kilobytes.
    """
    p = model if model is not None else trained(training_windows(docs))

    def run(batches):
        for batch in batches:
            spans = _spans([t or "" for t in batch.column("text").to_pylist()], p)
            base, spans = [b for b, _ in spans], [s for _, s in spans]
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            yield pa.record_batch(
                [batch.column("doc_id"), *counts, pa.array(map(joined, base), pa.string()), pa.array(map(joined, spans), pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"],
            )

    text = F.when(F.col("text").rlike(TRIGGER), F.col("text"))  # other texts hold no span and stay in the JVM
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", text.alias("text")).mapInArrow(run, f"doc_id long, {counts}, base string, spans string")
