"""Manifest, URL filters and divergence audit against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechviews.llm import divergence, merkle, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, steps string, place string, `group` string, term string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)


def made():
    rng = np.random.default_rng(4)
    words = "Alpha beta GAMMA delta épée straße naïve x1y2 o'clock don't _under_score zwölf".split()
    rows = []
    for k in range(90):
        text = " ".join(rng.choice(words, rng.integers(1, 40)))
        rows.append((int(k * 37 % 101), text, ["en", "de", "fr"][k % 7 % 3], f"s{k % 4}", len(text)))
    rows += [rows[5]] * 4 + [(rows[6][0], "same id, other text", rows[6][2], "s1", None)]
    rows += [(None, None, None, None, None), (None, "no id beta", "en", None, 5), (500, "", "", "", 0), (501, "lonely", "it", "s9", 6), (502, None, "en", "s8", 0)]
    rows += [(503, "tail " * 300_000 + "end", "en", "s1", 2**63 - 1), (504, "1234 !!", "en", "only digits", 7), (505, "\n\t ", None, "s0", 3)]
    return rows


# ------------------------------------------------------------- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests, arity):
    """Root, and for every leaf its (left, right) siblings up to it."""
    steps, owners, level = [[] for _ in digests], [[k] for k in range(len(digests))], list(digests)
    while len(level) > 1:
        parents, own = [], []
        for k in range(0, len(level), arity):
            run = level[k:k + arity]
            for j in range(len(run)):
                for leaf in owners[k + j]:
                    steps[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            parents.append(sha("".join(run)))
            own.append(sum(owners[k:k + arity], []))
        level, owners = parents, own
    return level[0], steps


def brute_leaf(row, add=0):
    doc_id, text, lang, source, n_chars = row
    fields = [doc_id, source, lang, None if n_chars is None else n_chars + add, text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def brute_manifest(rows, arity=2):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, brute_leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([m[2] for m in sorted(groups[g], key=lambda m: m[:3])], arity) for g in names}
    root, above = brute_tree([trees[g][0] for g in names], arity)
    out = []
    for g, over in zip(names, above):
        for (_, _, leaf, r), own in zip(sorted(groups[g], key=lambda m: m[:3]), trees[g][1]):
            steps = own + over
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = brute_leaf(r, 1) if hit else leaf
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((r[0], leaf, trees[g][0], root, sha("".join(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("arity, block", [(2, 4096), (2, 4), (3, 9)])
def test_manifest_equals_a_tree_built_level_by_level(spark, monkeypatch, arity, block):
    monkeypatch.setattr(merkle, "SLICE_ROWS", 7)
    rows = made()
    found = merkle.audited(table(spark, rows), arity, block).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == brute_manifest(rows, arity)


def test_manifest_tells_what_changed(spark):
    rows = made()
    kept = merkle.manifest(merkle.leaves(table(spark, rows))).cache()
    assert merkle.differences(table(spark, rows), kept).count() == 0
    changed = rows[1:3] + [(*rows[0][:4], 1)] + rows[4:] + [rows[5]]
    found = {(r.leaf, r.added) for r in merkle.differences(table(spark, changed), kept).collect()}
    assert found == {(brute_leaf(rows[0]), -1), (brute_leaf(changed[2]), 1), (brute_leaf(rows[3]), -1), (brute_leaf(rows[5]), 1)}
    forged = kept.withColumn("leaf", F.when(F.col("id") == 500, F.lit("0" * 64)).otherwise(F.col("leaf")))
    assert {(r.id, r.added) for r in merkle.differences(table(spark, rows), forged).collect()} == {(500, 1)}


def test_manifest_of_an_empty_table_and_of_one_row(spark):
    assert merkle.audited(table(spark, made()).limit(0)).count() == 0
    row = (9, "alone", None, None, 5)
    (found,) = merkle.audited(table(spark, [row])).collect()
    assert (found.leaf, found.root, found.proof_sha256) == (brute_leaf(row), brute_leaf(row), sha(""))


# ------------------------------------------------------------- URL filters

URLS = [
    None, "", "no scheme", "casino-x.com/a", "http://", "http://example.net/en/1", "HTTP://WWW.Example.NET/en/", "http://example.net/EN/", "http://notexample.net/en/",
    "http://example.net", "http://example.net?x=/en/", "http://a.b.net/", "http://a.net.org/", "http://example.com/de/1", "http://x.example.com/de", "http://example.com/de",
    "http://m.example.org/fr/7#top", "http://org/fr/", "http://www.casino-win.example.org/x", "http://cheap-pills.org", "http://x.org/casino/", "http://porn", "x://a://org/fr/",
    "http://user@example.net/en/", "http://ünï.net/é", "http://casino-x.example.net/en/", "http://x.org/" + "a/" * 200_000, "http://x.org/\nporn", "http://spam.farm.org/fr/1",
]


def brute_verdict(url):
    host, path = "", ""
    if url and "://" in url:
        rest = re.split("[?#]", url.split("://", 1)[1])[0]
        host, path = rest.split("/", 1)[0], "/" + rest.split("/", 1)[1] if "/" in rest else ""
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for verdict, rule in url_rules.ADDRESS_RULES:
        of, start = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    text = "".join(c.lower() if c.isascii() else c for c in url or "")
    text = text.split("://", 1)[1] if "://" in text else text
    labels = [text] + [text[m.end():] for m in re.finditer(r"\.", re.split("[/?#]", text)[0])]
    for p in url_rules.BLOCKED_PATTERNS:
        words = p.strip("|^").split("^")
        if any(re.split("[^a-z0-9]", label)[: len(words)] == words for label in labels):
            return host, path, None, "block"
    return host, path, None, "allow"


def urls(spark, values):
    return spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(values)], "page_id long, url string, host string, html string").repartition(2)


def test_urls_are_judged_as_by_every_rule(spark):
    found = url_rules.judged(urls(spark, URLS)).collect()
    assert sorted(found[0].asDict()) == ["host", "html", "page_id", "path", "pattern", "rule", "url", "verdict"]
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == brute_verdict(r.url), r.url
    assert len(found) == len(URLS)
    kept = url_rules.allowed(urls(spark, URLS))
    assert {r.page_id for r in kept.collect()} == {r.page_id for r in found if r.verdict == "allow"}
    assert url_rules.judged(urls(spark, URLS).limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token_and_blocks_change_nothing(spark):
    rules = [("pattern", f"/p{k}/*/q^", "block") for k in range(40)] + [("pattern", "*open*", "block"), ("pattern", "|www.", "allow"), ("pattern", ".gif|", "block")]
    rules += [("address", "bare.org", "allow"), ("address", "bare.org/x", "block"), ("pattern", "", "block"), ("pattern", "/P7/", "allow")]
    rules = spark.createDataFrame(rules, url_rules.RULES)
    values = [f"http://www.h{k % 3}.org/p{k}/z/q" for k in range(50)] + ["http://reopened.org/", "http://a.org/b.gif", "http://a.org/b.gif?", "http://bare.org/xy", "http://bare.org", "http://bare.orgs/"]
    values += ["http://a.org/p3/q", "http://a.org/p3/z/q1", "http://a.org/p7/", None]
    pages = urls(spark, values)
    whole = {r.page_id: (r.rule, r.pattern, r.verdict) for r in url_rules.judged(pages, rules).collect()}
    dealt = {r.page_id: (r.rule, r.pattern, r.verdict) for r in url_rules.judged(pages, rules, block_bytes=600).collect()}
    assert whole == dealt
    expected = {}
    for k, u in enumerate(values):
        m = re.match(r"http://www\.h\d\.org/p(\d+)/z/q$", u or "")
        expected[k] = (None, f"/p{m[1]}/*/q^", "block") if m and int(m[1]) < 40 else (None, "|www.", "allow") if m else None
    expected |= {50: (None, "*open*", "block"), 51: (None, ".gif|", "block"), 52: (None, None, "allow"), 53: ("bare.org/x", None, "block"), 54: ("bare.org", None, "allow")}
    expected |= {55: (None, None, "allow"), 56: (None, None, "allow"), 57: (None, None, "allow"), 58: (None, "/P7/", "allow"), 59: (None, None, "allow")}
    assert whole == expected
    filed = {r.rule: r.token for r in url_rules.index(pages.select("url"), rules).collect()}
    assert filed["/p39/*/q^"] == "p39" and filed["*open*"] is None and filed["/P7/"] == "p7" and filed["|www."] == "www" and filed["bare.org/x"] == "bare"


# ------------------------------------------------------------- divergence


def brute_divergence(rows, shown=200):
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
        langs[lang or ""].update(terms)
    kept = {lang: {t for t, n in docs[lang].items() if n >= 3} for lang in docs}

    def share(counter, lang):
        n = sum(counter[t] for t in kept[lang])
        return {t: 1 + 1_000_000_000 * (counter[t] + 1) // (n + len(kept[lang])) for t in kept[lang]}

    p, q = {g: share(c, g[0]) for g, c in counts.items()}, {lang: share(c, lang) for lang, c in langs.items()}
    out = []
    for (lang, source), own in p.items():
        pairs = [(-sum((own[t] - o[t]) ** 2 // o[t] for t in own), s.encode(), s) for (l2, s), o in p.items() if l2 == lang and s != source]
        terms = [(-((own[t] - q[lang][t]) ** 2 // q[lang][t]), t.encode(), t) for t in own if counts[lang, source][t] and own[t] > q[lang][t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:shown])):
            out += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk, piece, held", [(16_384, 1 << 20, 400_000), (4, 10, 3)])
def test_divergence_equals_every_term_of_every_pair(spark, monkeypatch, chunk, piece, held):
    for name, value in (("CHUNK", chunk), ("PIECE", piece), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = made() if held > 3 else [r for r in made() if len(r[1] or "") < 10_000]
    found = sorted(map(tuple, divergence.audited(table(spark, rows), shown=3).collect()))
    assert found == brute_divergence(rows, 3)


def test_divergence_without_kept_terms_or_rows(spark):
    assert divergence.audited(table(spark, []).limit(0)).count() == 0
    rows = [(1, "a b", "en", "x", 3), (2, "a c", "en", "y", 3), (3, None, "en", None, 0)]
    found = sorted(map(tuple, divergence.audited(table(spark, rows)).collect()))
    assert found == brute_divergence(rows) and {r[4] for r in found} == {0} and len(found) == 6


def test_shares_of_counts_beyond_the_range_of_a_product(spark):
    count, total, kinds = 10**12 + 7, 9 * 10**15 - 1_000, 3
    (found,) = spark.range(1).select(divergence._share(F.lit(count), F.lit(total), F.lit(kinds))).first()
    assert found == 1 + 10**9 * (count + 1) // (total + kinds)


def test_galloping_finds_the_first_place():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 3000), (3000, 40), (500, 500)):
        short, long = (np.sort(rng.choice(9000, k, replace=False)) for k in (n, m))
        assert (divergence.galloped(short, long) == np.searchsorted(long, short)).all()
