"""Language-model scoring by a hierarchical Pitman-Yor model over words.

Words follow contexts: every previous word, and the start of a text, is a restaurant of its own. All context
restaurants share one parent restaurant of words without context, whose base is uniform over the ``V`` training words and one
unknown. A word's customers in a context are its counts there; each of its tables is a customer of the parent. Gibbs
sweeps seat the customers of a word in a restaurant anew (Chinese restaurant process), given all others, and then
those in the parent. Scores take tables and parent averaged over the sweeps after ``BURN``.

Words are dealt by hash into groups of about ``GROUP_TOKENS`` tokens, so all counts and tables of a word are in one group.
A context's tables lie in many groups: after each sweep the groups send what they added to the group of the context as a
word, which adds up and replies (``exchanged``). Seats are not stored: a group repeats earlier sweeps from the replies and seeds.
Only dishes with two customers or more can have more than one table, so only those take part in the sweeps.

Words with more than ``HOT`` of all tokens (at most ``2 / HOT`` words), the end and the start would make one group large. Their totals are known
to all, and so are the dishes of a frequent word in a frequent context. Its dishes in another context are in that
context's group, as followers of a word there.

A chunk of documents asks each group once for all its tokens there. With ``A`` for strength and discounts of a context and ``n`` for its
customers, a word of probability ``p`` in the parent that keeps ``own`` customers has ``(own + A p) / (strength + n)``, so
its logarithm is a part of the entry, ``own / A + p``, which is in the word's group, and a part of the context,
``A / (strength + n)``, which is added where the context is asked for as a word: scoring needs no further shuffle.
Groups that are still large are asked in several parts.

Contexts are told apart by 48 bits of the 64 of a word's hash.

Nulls: a null text is empty and has the end token alone; a null id is scored, not held out and not learned from.
Repeated rows are rows like others. Without training tokens every score is 0. An empty table gives no rows.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from speechviews.llm.common import stored

HOT = 1 / 2048
CONTEXTS = 4098  # places for contexts known to all: 2 / HOT frequent words, the end, the start
GROUP_TOKENS = 2_000_000
CHUNK_BYTES, CHUNK_DOCS = 4 << 20, 60_000
SWEEPS, BURN = 5, 2
STRENGTH = 1.0
ALPHA = 0.1
# Codes of an entry: a frequent context, from CONTEXTS on a frequent word that follows, from COLD on another context.
COLD = 1 << 16
NONE = COLD - 1
DRIVER = -1  # in place of a group: sums for the driver
_END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds a newline


def context_of(h: np.ndarray) -> np.ndarray:
    """Code of a word as a context; larger hashes have larger codes."""
    return np.maximum(h >> np.uint64(16), np.uint64(COLD))


class Tokens:
    """Tokens of several texts in one row: hash, context and text of each; the last one of a text is its end.

    ``often`` marks frequent words, ``place`` is their number, ``next`` the number of the token that follows, or ``NONE``.
    """

    def __init__(self, texts: list[bytes], hot=np.zeros(0, np.uint64)):
        digest, end = xxhash.xxh3_64_intdigest, int(_END)
        words = [t.lower().split() for t in texts]
        self.sizes = np.array([len(w) + 1 for w in words], np.int64)
        hashes = (h for w in words for h in (*map(digest, w), end))
        self.h = np.fromiter(hashes, np.uint64, int(self.sizes.sum()))
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        self.place, self.often = _known(hot, self.h)
        self.context = np.empty_like(self.h)
        self.context[1:] = np.where(self.often, self.place.astype(np.uint64), context_of(self.h))[:-1]
        self.context[(np.cumsum(self.sizes) - self.sizes)[:len(texts)]] = len(hot)
        self.next = np.full(len(self.h), NONE, np.uint16)
        self.next[:-1] = np.where(self.often, self.place, NONE)[1:]


def _chunks(batches):
    """``(task's row number of the first, ids, train flags, texts)`` of about ``CHUNK_BYTES`` each."""
    row = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        ids, train = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        at = size = 0
        for k, n in enumerate(sizes):
            size += int(n) + 1
            if size >= CHUNK_BYTES or k - at + 1 == CHUNK_DOCS or k == len(sizes) - 1:
                part = [x or b"" for x in texts.slice(at, k + 1 - at).to_pylist()]
                yield row + at, ids.slice(at, k + 1 - at), train[at:k + 1], part
                at, size = k + 1, 0
        row += len(sizes)


def group_of(h: np.ndarray, groups: int) -> np.ndarray:
    """Group of a hash; larger hashes have larger groups."""
    return ((h >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)


def _known(sorted_words: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted list, and whether they are there."""
    if not len(sorted_words):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(sorted_words, h), len(sorted_words) - 1)
    return at, sorted_words[at] == h


def _packed(codes: np.ndarray) -> bytes:
    """Codes in two bytes below ``COLD``, in six above."""
    small = codes < COLD
    large = np.ascontiguousarray(codes[~small]).view(np.uint8).reshape(-1, 8)[:, :6]
    return len(codes).to_bytes(8, "little") + np.packbits(small).tobytes() + codes[small].astype(np.uint16).tobytes() + large.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    at = 8 + (n + 7) // 8
    small = np.unpackbits(np.frombuffer(data[8:at], np.uint8), count=n).astype(bool)
    end = at + 2 * int(small.sum())
    codes = np.empty(n, np.uint64)
    codes[small] = np.frombuffer(data[at:end], np.uint16)
    large = np.zeros(((len(data) - end) // 6, 8), np.uint8)
    large[:, :6] = np.frombuffer(data[end:], np.uint8).reshape(-1, 6)
    codes[~small] = large.view(np.uint64).ravel()
    return codes


# ---------------------------------------------------------------- model of one group of words


@dataclass
class Totals:
    """What a sweep leaves for the next and all groups know: tables and customers of every frequent context's restaurant
    and of the parent, and the frequent words' probabilities in the parent."""

    tables: np.ndarray
    customers: np.ndarray
    root_tables: float
    root_customers: float
    words: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class Shape:
    """Sizes and discounts that all sweeps share."""

    tokens: int
    words: int
    discount: float
    root_discount: float


class Dishes:
    """Counts of a group's words by context, and by frequent word that follows; words ascend, codes ascend within a word."""

    def __init__(self, words, sizes, context, n):
        self.words, self.sizes, self.context, self.n = words, sizes, context.astype(np.uint64, copy=False), n.astype(np.uint32, copy=False)

    @property
    def home(self):
        """Each entry's word."""
        return np.repeat(np.arange(len(self.words), dtype=np.int32), self.sizes)

    @property
    def follows(self):
        """Whether an entry is a frequent word that follows the entry's word."""
        return (self.context >= CONTEXTS) & (self.context < COLD)

    def sites(self):
        """Code of each entry's context."""
        return np.where(self.follows, np.repeat(context_of(self.words), self.sizes), self.context)

    def many(self):
        """Entries of two customers or more, those of most customers first."""
        many = np.nonzero(self.n > 1)[0].astype(np.int32)
        return many[np.argsort(-self.n[many].astype(np.int64), kind="stable")]

    @classmethod
    def of(cls, row):
        kinds = (("words", np.uint64), ("sizes", np.uint32))
        return cls(*(np.frombuffer(row[name], kind) for name, kind in kinds), _unpacked(row["contexts"]), np.frombuffer(row["counts"], np.uint32))

    @classmethod
    def merged(cls, parts):
        """Dishes with the counts of several added up."""
        h = np.concatenate([np.repeat(p.words, p.sizes) for p in parts])
        context = np.concatenate([p.context for p in parts])
        n = np.concatenate([p.n for p in parts])
        order = sorted_by(h, context)
        return cls.counted(h[order], context[order], n[order])

    @classmethod
    def counted(cls, h, context, n):
        """Dishes from sorted (hash, context) pairs that may repeat."""
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (context[1:] != context[:-1])
        at = np.nonzero(new)[0]
        total = np.add.reduceat(n, at, dtype=np.uint32) if len(at) else np.zeros(0, np.uint32)
        words, sizes = np.unique(h[at], return_counts=True)
        return cls(words, sizes, context[at], total)

    def columns(self) -> list[bytes]:
        return [self.words.astype(np.uint64).tobytes(), self.sizes.astype(np.uint32).tobytes(),
                _packed(self.context), self.n.astype(np.uint32).tobytes()]

    def sweeps(self, shape: Shape, totals: list[Totals], seed: int, cold=()):
        """After each sweep: tables by entry, parent's customers and tables by word. For ``cold`` see ``Seats``."""
        many, tables = self.many(), np.ones(len(self.n), np.uint32)
        for now, customers, root_tables in Seats.among(self).sweeps(shape, totals, seed, cold):
            tables[many] = now
            yield tables, customers, root_tables


class Seats:
    """What the sweeps need of a group: dishes of two customers or more, most customers first, and each word's number of contexts.

    ``word`` counts on from the group's words to the frequent ones. ``slot`` is the place of a frequent
    context, or ``CONTEXTS`` and the place in ``contexts``, which ascend.
    """

    FIELDS = (("sizes", np.uint32), ("n", np.uint32), ("word", np.uint32), ("slot", np.uint32))

    def __init__(self, sizes, n, word, slot, contexts):
        self.sizes, self.n, self.word, self.slot, self.contexts = sizes, n, word, slot, contexts

    @classmethod
    def among(cls, dishes: Dishes):
        many, home, follows = dishes.many(), dishes.home, dishes.follows
        sizes = np.bincount(home[~follows], minlength=len(dishes.words))
        word = np.where(follows[many], dishes.context[many].astype(np.int64) + len(sizes) - CONTEXTS, home[many])
        site = dishes.sites()[many]
        contexts = np.unique(site[site >= COLD])
        slot = np.where(site < COLD, site, np.uint64(CONTEXTS) + np.searchsorted(contexts, site).astype(np.uint64))
        return cls(sizes, dishes.n[many], word, slot.astype(np.int64), contexts)

    @classmethod
    def of(cls, row):
        sizes, n, word, slot = (np.frombuffer(row[name], kind) for name, kind in cls.FIELDS)
        return cls(sizes, n, word.astype(np.int64), slot.astype(np.int64), _unpacked(row["contexts"]))

    def columns(self) -> list[bytes]:
        return [*(getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS), _packed(self.contexts)]

    def added(self, tables) -> np.ndarray:
        """Tables beyond the first of each dish, by slot."""
        return np.bincount(self.slot, weights=tables - 1.0, minlength=CONTEXTS + len(self.contexts)).astype(np.int64)

    def sweeps(self, shape: Shape, totals: list[Totals], seed: int, cold=()):
        """After each sweep: tables by dish, parent's customers and tables by word. ``cold`` has the tables of ``contexts`` before each."""
        sizes, many_n = self.sizes.astype(np.int64), self.n.astype(np.int64)
        customers, root_tables = sizes, np.ones(len(sizes), np.int64)
        tables, own = np.ones(len(many_n), np.int64), self.word < len(sizes)
        base = 1 / (shape.words + 1)
        for sweep, last in enumerate(totals):
            rng = np.random.default_rng([seed & 0xFFFFFFFF, seed >> 32, sweep])
            p0 = np.concatenate([root_probability(shape, last, customers, root_tables), last.words])
            others = np.concatenate([last.tables, cold[sweep]]) if len(cold) else last.tables
            tables = seated(many_n, others[self.slot] - tables, p0[self.word], shape.discount, rng)
            customers = sizes + np.bincount(self.word[own], weights=tables[own] - 1, minlength=len(sizes)).astype(np.int64)
            root_tables = root_seated(shape, last, customers, root_tables, base, rng)
            yield tables, customers, root_tables


def root_probability(shape: Shape, t: Totals, customers, tables):
    """Probability of words in the parent restaurant."""
    base = 1 / (shape.words + 1)
    rest = (STRENGTH + shape.root_discount * t.root_tables) * base
    return (customers - shape.root_discount * tables + rest) / (STRENGTH + t.root_customers)


def root_seated(shape: Shape, last: Totals, customers, tables, base, rng):
    """Tables of words in the parent restaurant, seated anew."""
    order = np.argsort(-customers, kind="stable")
    new = np.empty_like(tables)
    new[order] = seated(customers[order], last.root_tables - tables[order], np.full(len(order), base), shape.root_discount, rng)
    return new


def seated(customers, other_tables, p, discount, rng) -> np.ndarray:
    """Tables after seating ``customers`` (descending, at least one) of each dish one after another.

    A customer opens a table in proportion to (strength + discount * all tables) * p, or joins one of the dish in
    proportion to its customers less a discount each. Beyond 32 customers blocks of a sixteenth draw at once.
    """
    tables = np.ones(len(customers), np.int64)
    seats, top = 1, int(customers[0]) if len(customers) else 0
    while seats < top:
        block = max(1, seats // 16)
        n = int(np.searchsorted(-customers, -seats, side="left"))  # dishes with more customers than that
        t = tables[:n]
        opens = (STRENGTH + discount * (other_tables[:n] + t)) * p[:n]
        chance = opens / (opens + seats - discount * t)
        if block == 1:
            tables[:n] = t + (rng.random(n) < chance)
        else:
            tables[:n] = t + rng.binomial(np.minimum(block, customers[:n] - seats), chance)
        seats += block
    return tables


class Scorer:
    """Log probabilities under a group's restaurants, with tables and parent averaged over the kept sweeps.

    ``ratio`` is what an entry's customers keep after their tables' discounts, over the mass that its context gives
    to the parent. ``cold`` and ``mean`` are the tables of other contexts before each sweep and after the kept ones, the
    latter of all contexts in ``asked_of(dishes)``.
    """

    def __init__(self, dishes: Dishes, shape: Shape, totals: list[Totals], seed: int, cold=(), mean=np.zeros(0)):
        kept = totals[BURN + 1:]
        tables, parent = np.zeros(len(dishes.n)), np.zeros(len(dishes.words))
        for sweep, (now, customers, root_tables) in enumerate(dishes.sweeps(shape, totals[:-1], seed, cold)):
            if sweep >= BURN:
                tables += now
                parent += root_probability(shape, totals[sweep + 1], customers, root_tables)
        self.shape, self.words, self.parent = shape, dishes.words, parent / len(kept)
        self.none = sum(root_probability(shape, t, 0, 0) for t in kept) / len(kept)
        self.frequent = sum(t.words for t in kept) / len(kept)
        mass = STRENGTH + shape.discount * sum(t.tables for t in kept) / len(kept)
        self.given = np.log10(mass / (STRENGTH + totals[-1].customers))
        known, site, follows = asked_of(dishes), dishes.sites(), dishes.follows
        others = STRENGTH + shape.discount * mean
        at = np.where(site < COLD, site, np.uint64(len(mass)) + np.searchsorted(known, site).astype(np.uint64)).astype(np.int64)
        ratio = (dishes.n - shape.discount / len(kept) * tables) / np.concatenate([mass, others])[at]
        key = self.key_of(np.repeat(dishes.words, dishes.sizes), dishes.context)
        order = np.argsort(key, kind="stable")
        self.key, self.ratio = key[order], ratio[order]
        self.count = np.bincount(dishes.home, weights=np.where(follows, 0, dishes.n), minlength=len(dishes.words))
        self.after = np.zeros(len(dishes.words))
        if len(mean):
            mine, same = np.unique(context_of(dishes.words), return_inverse=True)
            customers = np.bincount(same, weights=self.count)
            self.after = np.log10(others[np.searchsorted(known, mine)] / (STRENGTH + customers))[same]

    @classmethod
    def of(cls, dishes: Dishes, shape: Shape, totals: list[Totals], seed: int, cold=(), mean=np.zeros(0)):
        return cls(dishes, shape, totals, seed, cold, mean)

    @staticmethod
    def key_of(h, code):
        return h + code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def seen(self, h, code):
        """``ratio`` of the entries asked for, 0 for those not there."""
        entry, there = _known(self.key, self.key_of(h, code))
        return np.where(there, self.ratio[entry], 0.0) if len(self.key) else np.zeros(len(h))

    def score(self, h, context, following=None):
        """``(base, score, known)`` of tokens.

        The score lacks the part of a context that is not frequent, and has with ``following`` the part of the token as a context and
        the score of the frequent word that follows it.
        """
        shape = self.shape
        word, known = _known(self.words, h)
        of_word = lambda values, none: np.where(known, values[word], none) if len(self.words) else np.full(len(h), none)
        base = np.log10((of_word(self.count, 0.0) + ALPHA) / (shape.tokens + ALPHA * (shape.words + 1)))
        score = np.log10(self.seen(h, context) + of_word(self.parent, self.none))
        often = context < COLD
        score[often] += self.given[context[often].astype(np.int64)]
        if following is not None:
            score += of_word(self.after, 0.0)
            at = following != NONE
            follower = following[at].astype(np.int64)
            score[at] += np.log10(self.seen(h[at], follower + CONTEXTS) + self.frequent[follower])
        return base, score, known


def asked_of(dishes: Dishes) -> np.ndarray:
    """All contexts of a group that are not frequent, its words among them."""
    return np.unique(np.concatenate([dishes.context[dishes.context >= COLD], context_of(dishes.words)]))


class Frequent:
    """The frequent words and their dishes in frequent contexts; the driver seats them, all tasks score with them.

    ``types`` and ``count`` are the words' contexts and tokens, those in other contexts included.
    """

    def __init__(self, words, dishes: tuple, types, count):
        self.words, self.types, self.count = words, types, count
        context, word, n = dishes
        order = np.argsort(-n, kind="stable")
        self.context, self.word, self.n = context[order], word[order], n[order]
        self.tables = np.ones(len(n), np.int64)
        self.root_tables = (types > 0).astype(np.int64)
        self.kept = np.zeros(len(n))

    def in_parent(self, shape: Shape, t: Totals, customers) -> np.ndarray:
        return np.where(customers > 0, root_probability(shape, t, customers, self.root_tables), root_probability(shape, t, 0, 0))

    def swept(self, shape: Shape, start: Totals, last: Totals, sweep: int, added: np.ndarray) -> Totals:
        """Totals after a sweep. ``added``: tables that groups added by frequent context and frequent word, their parent's customers and tables."""
        rng = np.random.default_rng([0, 1 << 31, sweep])
        self.tables = seated(self.n, last.tables[self.context] - self.tables, last.words[self.word], shape.discount, rng)
        if sweep >= BURN:
            self.kept += self.tables
        more = lambda of, size: np.bincount(of, weights=self.tables - 1.0, minlength=size).astype(np.int64)
        tables = start.tables + added[:CONTEXTS] + more(self.context, CONTEXTS)
        customers = self.types + added[CONTEXTS:-2] + more(self.word, len(self.words))
        there = customers > 0
        self.root_tables[there] = root_seated(shape, last, customers[there], self.root_tables[there], 1 / (shape.words + 1), rng)
        now = Totals(tables, start.customers, float(added[-1] + self.root_tables.sum()), float(added[-2] + customers.sum()))
        now.words = self.in_parent(shape, now, customers)
        return now

    def scorer(self, shape: Shape, totals: list[Totals]):
        """``(place, context)`` of frequent words to ``(base, score, known)``; the score is 0 where the context is not frequent."""
        kept, count = totals[BURN + 1:], self.count
        parent = sum(t.words for t in kept) / len(kept)
        mass = STRENGTH + shape.discount * sum(t.tables for t in kept) / len(kept)
        given = STRENGTH + totals[-1].customers
        key = self.word * CONTEXTS + self.context
        order = np.argsort(key)
        key, own = key[order], (self.n - shape.discount / len(kept) * self.kept)[order]

        def score(place, context):
            base = np.log10((count[place] + ALPHA) / (shape.tokens + ALPHA * (shape.words + 1)))
            found, often = np.zeros(len(place)), context < COLD
            place_, context_ = place[often], context[often].astype(np.int64)
            entry, seen = _known(key, place_ * CONTEXTS + context_)
            keeps = np.where(seen, own[entry], 0.0) if len(key) else np.zeros(len(place_))
            found[often] = np.log10((keeps + mass[context_] * parent[place_]) / given[context_])
            return base, found, count[place] > 0

        return score


def sorted_by(h, context):
    """Order by hash, then context."""
    order = np.argsort(context, kind="stable").astype(np.int32)
    return order[np.argsort(h[order], kind="stable")]


# ---------------------------------------------------------------- Spark

_DISH = "group long, tokens long, words binary, sizes binary, contexts binary, counts binary"


_SEATS = "group long, sizes binary, n binary, word binary, slot binary, contexts binary"
_SENT = "home long, group long, contexts binary, added binary, wanted boolean"
_REPLY = "group long, home long, tables binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _table(schema: str, rows: list[tuple]):
    """Rows as an Arrow table with the columns of a Spark schema."""
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    return pa.table({name: pa.array([r[k] for r in rows], _KINDS[kind]) for k, (name, kind) in enumerate(zip(names, kinds))})


def _dish_table(group, dishes):
    return _table(_DISH, [(group, int(dishes.n.sum()), *dishes.columns())])


def _rows(table):
    """Rows one by one, as dictionaries."""
    for batch in table.to_batches():
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def frequent_words(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training tokens, and the hashes of words with more than ``HOT`` of them (some with half as many) and of the end."""

    def run(batches):
        for _, _, train, texts in _chunks(batches):
            t = Tokens([x for x, use in zip(texts, train) if use])
            words, n = np.unique(t.h, return_counts=True)
            often = n > HOT / 2 * len(t.h)
            yield pa.record_batch([pa.array([*words[often].view(np.int64), None], pa.int64()), pa.array([*n[often], len(t.h)], pa.int64())], ["h", "n"])

    sums = rows.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    total = sums.where("h is null").agg(F.sum("n")).first()[0] or 0
    found = sums.where("h is not null").where(F.col("n") > HOT / 2 * total).select("h").collect()
    return total, np.unique(np.append(np.array([r.h for r in found], np.int64).view(np.uint64), _END))


def _hot_dishes(rows: DataFrame, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and count of the frequent words' dishes in frequent contexts."""

    def run(batches):
        total = np.zeros(len(hot) * (len(hot) + 1), np.int64)
        for _, _, train, texts in _chunks(batches):
            t = Tokens([x for x, use in zip(texts, train) if use], hot)
            both = t.often & (t.context < COLD)
            total += np.bincount(t.context[both].astype(np.int64) * len(hot) + t.place[both], minlength=len(total))
        key = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(key), pa.array(total[key])], ["key", "n"])

    counts = rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")
    key, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    return key // len(hot), key % len(hot), n


def _other_dishes(rows: DataFrame, hot: np.ndarray, groups: int, parts: int) -> DataFrame:
    """Restaurants of all other words, and the frequent words that follow them, one row a group."""

    def run(batches):
        for first, _, train, texts in _chunks(batches):
            t = Tokens([x for x, use in zip(texts, train) if use], hot)
            leads = ~t.often & (t.next != NONE)
            h = np.concatenate([t.h[~t.often], t.h[leads]])
            context = np.concatenate([t.context[~t.often], t.next[leads].astype(np.uint64) + np.uint64(CONTEXTS)])
            order = sorted_by(h, context)
            d = Dishes.counted(h[order], context[order], np.ones(len(order), np.uint32))
            cut = np.append(np.searchsorted(group_of(d.words, groups), np.arange(groups)), len(d.words))
            ends = np.concatenate([[0], np.cumsum(d.sizes)])
            for g in np.nonzero(np.diff(cut))[0]:
                a, b = cut[g], cut[g + 1]
                part = Dishes(d.words[a:b], d.sizes[a:b], d.context[ends[a]:ends[b]], d.n[ends[a]:ends[b]])
                yield from _dish_table(int(g), part).to_batches()

    def merge(table):
        return _dish_table(table.column("group")[0].as_py(), Dishes.merged([Dishes.of(r) for r in _rows(table)]))

    sent = rows.mapInArrow(run, _DISH)
    if parts > 1:  # very many chunks: add up within parts first
        sent = sent.withColumn("part", F.pmod(F.xxhash64("words"), F.lit(parts)))
        sent = sent.groupBy("group", "part").applyInArrow(lambda t: merge(t.drop(["part"])), _DISH)
    return sent.groupBy("group").applyInArrow(merge, _DISH)


def _shape(dishes: DataFrame, hot: np.ndarray, pairs: tuple) -> tuple[Shape, Totals, Frequent]:
    """Sizes, discounts (from how many counts are one and two) and the totals of the first seating: one table a dish."""
    size = CONTEXTS + len(hot)

    def facts_of(n, contexts_of_word):
        return [len(contexts_of_word), len(n), *(int((x == k).sum()) for x in (n, contexts_of_word) for k in (1, 2)), int(n.sum())]

    def run(batches):
        for batch in batches:
            for row in _rows(pa.Table.from_batches([batch])):
                d = Dishes.of(row)
                facts = facts_of(d.n, np.bincount(d.home[~d.follows], minlength=len(d.words)))
                shared = d.context < COLD
                place = d.context[shared].astype(np.int64)
                types, n = np.bincount(place, minlength=size), np.bincount(place, weights=d.n[shared], minlength=size)
                key = np.concatenate([np.nonzero(types)[0], -1 - np.arange(len(facts))])
                a = np.concatenate([types[types > 0], facts]).astype(np.int64)
                b = np.concatenate([n[types > 0], np.zeros(len(facts))]).astype(np.int64)
                yield pa.record_batch([pa.array(key), pa.array(a), pa.array(b)], ["key", "a", "b"])

    context, word, n = pairs
    both = np.concatenate([context, CONTEXTS + word])
    types, count = np.bincount(both, minlength=size), np.bincount(both, weights=np.concatenate([n, n]), minlength=size)
    facts = np.zeros(7)
    for r in dishes.mapInArrow(run, "key long, a long, b long").groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect():
        if r.key < 0:
            facts[-1 - r.key] = r.a
        else:
            types[r.key] += r.a
            count[r.key] += r.b
    frequent = Frequent(hot, pairs, types[CONTEXTS:], count[CONTEXTS:])
    facts += facts_of(n, frequent.types[frequent.types > 0])
    words, entries, once, twice, root_once, root_twice, tokens = facts
    discount = lambda one, two: float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.95))
    shape = Shape(int(tokens), int(words), discount(once, twice), discount(root_once, root_twice))
    start = Totals(types[:CONTEXTS], count[:CONTEXTS], float(words), float(entries))
    start.words = frequent.in_parent(shape, start, frequent.types)
    return shape, start, frequent


def _letters(group: int, groups: int, contexts: np.ndarray, added: np.ndarray, wanted: bool) -> list[tuple]:
    """What a group sends to the groups of contexts."""
    cut = np.append(np.searchsorted(group_of(contexts << np.uint64(16), groups), np.arange(groups)), len(contexts))
    return [(int(g), group, _packed(contexts[cut[g]:cut[g + 1]]), added[cut[g]:cut[g + 1]].astype(np.uint32).tobytes(), wanted)
            for g in np.nonzero(np.diff(cut))[0]]


def exchanged(sent: DataFrame) -> DataFrame:
    """Sums over all senders by context, sent back to those who want them in the order of their contexts."""

    def add_up(table):
        rows = list(_rows(table))
        if rows[0]["home"] == DRIVER:
            return _table(_REPLY, [(DRIVER, DRIVER, sum(np.frombuffer(r["added"], np.int64) for r in rows).tobytes())])
        contexts = [_unpacked(r["contexts"]) for r in rows]
        known = np.unique(np.concatenate(contexts))
        total = np.zeros(len(known), np.int64)
        for r, c in zip(rows, contexts):
            total[np.searchsorted(known, c)] += np.frombuffer(r["added"], np.uint32)
        return _table(_REPLY, [(r["group"], r["home"], total[np.searchsorted(known, c)].astype(np.uint32).tobytes())
                               for r, c in zip(rows, contexts) if r["wanted"]])

    return sent.groupBy("home").applyInArrow(add_up, _REPLY)


def _replies(rows, sweeps: int) -> list[np.ndarray]:
    """A group's replies, by sweep, as tables of its contexts: first those of one table a dish, then what was added to them."""
    found = [[] for _ in range(sweeps)]
    for r in sorted(rows, key=lambda r: r["home"]):
        found[r["sweep"]].append(np.frombuffer(r["tables"], np.uint32).astype(np.int64))
    first, *added = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    return [first, *(first + x for x in added)]


def sampled(dishes: DataFrame, hot: np.ndarray, pairs: tuple, groups: int) -> tuple[Shape, list[Totals], Frequent, DataFrame]:
    """Totals before the first and after every Gibbs sweep, and the groups' replies (``sweep``; that of ``SWEEPS`` has the sums over the kept
    sweeps for all contexts of ``asked_of``)."""
    shape, start, frequent = _shape(dishes, hot, pairs)
    kept = SWEEPS - BURN

    def settle(batches):
        for batch in batches:
            for row in _rows(pa.Table.from_batches([batch])):
                yield from _table(_SEATS, [(row["group"], *Seats.among(Dishes.of(row)).columns())]).to_batches()

    def first(batches, times=1, all_wanted=False):
        for batch in batches:
            for row in _rows(pa.Table.from_batches([batch])):
                d = Dishes.of(row)
                site = d.sites()
                contexts = asked_of(d)
                types = np.bincount(np.searchsorted(contexts, site[site >= COLD]), minlength=len(contexts))
                out = _letters(row["group"], groups, contexts, times * types, all_wanted)
                if not all_wanted:
                    wanted = Seats.among(d).contexts
                    out += _letters(row["group"], groups, wanted, np.zeros(len(wanted)), True)
                yield from _table(_SENT, out).to_batches()

    seats = stored(dishes.mapInArrow(settle, _SEATS), "seats")
    replies = stored(exchanged(dishes.mapInArrow(first, _SENT)), "replies").withColumn("sweep", F.lit(0))
    totals = [start]
    for sweep in range(SWEEPS):
        last = sweep == SWEEPS - 1

        def run(seat, given):
            row = next(_rows(seat))
            s = Seats.of(row)
            kept_tables = 0
            for k, (tables, customers, root_tables) in enumerate(s.sweeps(shape, totals, row["group"], _replies(_rows(given), len(totals)))):
                if k >= BURN:
                    kept_tables = kept_tables + tables - 1
            added, frequent_word = s.added(tables), s.word >= len(s.sizes)
            words = np.bincount(s.word[frequent_word] - len(s.sizes), weights=tables[frequent_word] - 1, minlength=len(hot))
            sums = np.concatenate([added[:CONTEXTS], words, [customers.sum(), root_tables.sum()]]).astype(np.int64)
            out = _letters(row["group"], groups, s.contexts, s.added(kept_tables + 1 if last else tables)[CONTEXTS:], not last)
            return _table(_SENT, [*out, (DRIVER, row["group"], None, sums.tobytes(), False)])

        sent = seats.groupBy("group").cogroup(replies.groupBy("group")).applyInArrow(run, _SENT)
        if last:
            sent = sent.unionByName(dishes.mapInArrow(lambda b: first(b, kept, True), _SENT))
        got = stored(exchanged(sent), "replies")
        added = got.where(F.col("group") == DRIVER).first()
        added = np.frombuffer(added.tables, np.int64) if added else np.zeros(CONTEXTS + len(hot) + 2, np.int64)
        totals.append(frequent.swept(shape, start, totals[-1], sweep, added))
        replies = replies.unionByName(got.where(F.col("group") != DRIVER).withColumn("sweep", F.lit(sweep + 1)))
    return shape, totals, frequent, replies


_ASKED = ("group long, part long, chunk long, words binary, starts binary, texts binary, contexts binary, following binary, at binary, known binary, base binary, score binary, "
          "ids array<long>, held_out array<boolean>, n array<long>")
_ANSWERED = "chunk long, at binary, known binary, base binary, score binary, ids array<long>, held_out array<boolean>, n array<long>"


def _sums(text, base, score, known) -> tuple[bytes, bytes, bytes, bytes]:
    """Texts of a chunk that have tokens here; their known tokens, base and score."""
    at = np.unique(text)
    add = lambda v: np.bincount(text, weights=v)[at] if len(at) else np.zeros(0)
    return at.astype(np.uint16).tobytes(), add(known).astype(np.uint32).tobytes(), add(base).tobytes(), add(score).tobytes()


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    tenth = F.crc32(F.col("doc_id").cast("string")) % 10
    rows = docs.select("doc_id", "text", F.coalesce(tenth != 0, F.lit(False)).alias("train"), F.coalesce(tenth == 0, F.lit(False)).alias("held_out"))
    learn = rows.select("doc_id", "text", "train").where("train")
    tokens, hot = frequent_words(learn)
    groups = max(1, -(-tokens // GROUP_TOKENS))
    parts = max(1, int(tokens * HOT / GROUP_TOKENS))
    dishes = stored(_other_dishes(learn, hot, groups, parts), "restaurants")
    shape, totals, frequent, replies = sampled(dishes, hot, _hot_dishes(learn, hot), groups)
    large = {r.group: r.k for r in dishes.select("group", F.ceil(F.col("tokens") / (2 * GROUP_TOKENS)).alias("k")).where("k > 1").collect()}
    nothing = Dishes(*(np.zeros(0, k) for k in (np.uint64, np.int64, np.uint64, np.uint32)))
    score_frequent = frequent.scorer(shape, totals)

    def ask(batches):
        task = TaskContext.get().partitionId() << 40
        for first, ids, held_out, texts in _chunks(batches):
            t = Tokens(texts, hot)
            mine = t.often
            base, score, known = score_frequent(t.place[mine], t.context[mine])
            chunk = task + first
            part = first // CHUNK_DOCS + TaskContext.get().partitionId()
            out = [(-1 - part, 0, chunk, *[None] * 5, *_sums(t.text[mine], base, score, known), ids.to_pylist(), held_out.tolist(), t.sizes.tolist())]
            # A frequent word's own part as a context is in its followers' scores.
            h, text, context, following = t.h[~mine], t.text[~mine], t.context[~mine], t.next[~mine]
            order = np.argsort(h, kind="stable")
            h, text, context, following = h[order], text[order].astype(np.uint16), context[order], following[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            cut = np.append(np.searchsorted(group_of(h, groups), np.arange(groups)), len(h))
            for g in np.nonzero(np.diff(cut))[0]:
                a, b = cut[g], cut[g + 1]
                out.append((int(g), part % large.get(int(g), 1), chunk, h[a:b][new[a:b]].tobytes(), np.packbits(new[a:b]).tobytes(), text[a:b].tobytes(),
                            _packed(context[a:b]), following[a:b].tobytes(), *[None] * 7))
            yield from _table(_ASKED, out).to_batches()

    def answer(asked, known):
        scorer, rows, out = None, list(_rows(known)), []
        names = ["chunk", "at", "known", "base", "score", "ids", "held_out", "n"]
        for r in _rows(asked):
            if r["group"] < 0:  # what the chunk has scored itself
                out.append(tuple(r[n] for n in names))
                continue
            if scorer is None:
                found = [Dishes.of(x) for x in rows if x["sweep"] is None]
                given = [x for x in rows if x["sweep"] is not None]
                cold = _replies([x for x in given if x["sweep"] < SWEEPS], SWEEPS)
                mean = _replies([{**x, "sweep": 0} for x in given if x["sweep"] == SWEEPS], 1)[0] / (SWEEPS - BURN)
                scorer = Scorer.of(found[0] if found else nothing, shape, totals, r["group"], cold, mean)
            text = np.frombuffer(r["texts"], np.uint16).astype(np.int64)
            starts = np.unpackbits(np.frombuffer(r["starts"], np.uint8), count=len(text))
            h = np.frombuffer(r["words"], np.uint64)[np.cumsum(starts) - 1]
            out.append((r["chunk"], *_sums(text, *scorer.score(h, _unpacked(r["contexts"]), np.frombuffer(r["following"], np.uint16))), None, None, None))
        return _table(_ANSWERED, out)

    def add_up(table):
        """The sums of a chunk's documents over all groups."""
        known, base, score = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS), np.zeros(CHUNK_DOCS)
        for r in _rows(table):
            if r["ids"] is not None:
                head = r
            at = np.frombuffer(r["at"], np.uint16)
            for total, name, kind in ((known, "known", np.uint32), (base, "base", np.float64), (score, "score", np.float64)):
                total[at] += np.frombuffer(r[name], kind)
        n = len(head["ids"])
        return pa.table({
            "doc_id": pa.array(head["ids"], pa.int64()), "held_out": pa.array(head["held_out"]), "n_tokens": pa.array(head["n"], pa.int64()),
            "n_known": known[:n], "base_score": base[:n], "score": score[:n],
        })

    asked = rows.select("doc_id", "text", F.col("held_out").alias("train")).mapInArrow(ask, _ASKED)
    known = dishes.drop("tokens").withColumns({"home": F.lit(None).cast("long"), "tables": F.lit(None).cast("binary"), "sweep": F.lit(None).cast("int")})
    known = known.unionByName(replies, allowMissingColumns=True)
    parts_of = F.coalesce(F.create_map(*[F.lit(x).cast("long") for pair in large.items() for x in pair])[F.col("group")], F.lit(1)) if large else F.lit(1)
    known = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts_of.cast("long") - 1)))
    sums = asked.groupBy("group", "part").cogroup(known.groupBy("group", "part")).applyInArrow(answer, _ANSWERED)
    whole = sums.groupBy("chunk").applyInArrow(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(shape.tokens).cast("long").alias("train_tokens"), "base_score", "score")
