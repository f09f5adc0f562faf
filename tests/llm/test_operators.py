"""The operators against brute force, on rows with nulls, ties, copies and clashing columns."""

import hashlib
import itertools
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from speechviews.llm.common import components, fit_sample
from speechviews.llm import (
    histogram_shards, license_digest, mil_quality, pii, pitman_yor, pivotal_mix, robust_rules, simhash, suffix_dedup, templates,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, `group` string, slice string, text_key string"
PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing in a tall green tree near my old house".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    words = []
    while len(words) < n:
        words.append(PROSE[rng.integers(len(PROSE))] + "xyzuv"[rng.integers(5)])
    return " ".join(words) + "."


def made_rows():
    shared = prose(1000, 30)
    rows = []
    for k in range(60):
        text = prose(k, 60 + 7 * (k % 11))
        if k % 5 == 0:
            text = text + "\n" + shared
        rows.append((k, text, "en" if k % 2 else "de", f"s{k % 4}"))
    rows += [(100 + k, rows[3][1], "en", "s1") for k in range(5)]  # copies
    rows += [(110 + k, rows[4][1].replace(".", f" end{k}."), "de", "s0") for k in range(4)]  # near copies
    rows += [(7, rows[7][1], rows[7][2], rows[7][3])] * 2  # repeated rows
    rows += [(8, "another text under the same id " + prose(77, 50), "en", "s2")]
    rows += [(None, None, None, None), (None, prose(5, 70), None, "s1"), (200, None, "en", "s1"), (201, "", "en", None), (202, " \n\t ", "en", "s1")]
    rows += [(203, "one", "en", "s1"), (204, "Wide *** | &&& " * 60, "en", "s1"), (205, prose(6, 9000), "de", "s3"), (206, "same " * 500, "en", "s2")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(text):
    return (text or "").encode().split()


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------- personal data


def brute_spans(text):
    def luhn(d):
        s = [int(c) for c in d[::-1]]
        return (sum(s[::2]) + sum(sum(divmod(2 * c, 10)) for c in s[1::2])) % 10 == 0

    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


PERSONAL = [
    "mail me at a.b+c@mail.example.com, or x@y", "host 10.0.255.1 and 300.1.1.1 and 1.2.3.4.5", "card 4111 1111 1111 1111 not 4111 1111 1111 1112",
    "call +1 (555) 010-9999 now", "+12", "é 4111111111111111 10.1.1.1", "", None, "no digits here", "a@b.c" * 3, "x" * 300 + " 8.8.8.8 " + "y" * 300,
]


def test_base_spans_are_those_of_the_patterns(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(PERSONAL)], "doc_id long, text string")
    for row in pii.found(df).collect():
        expected = brute_spans(PERSONAL[row.doc_id] or "")
        assert row.base == expected
        assert set(filter(None, expected.split(","))) <= set(filter(None, row.spans.split(",")))
        assert row.n_email == expected.count("email")


def test_redaction_replaces_every_span_and_keeps_columns(spark):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(PERSONAL)], "doc_id long, text string, kept string")
    spans = {r.doc_id: r for r in pii.found(df).collect()}
    for r in pii.redacted(df).collect():
        assert r.kept == "x"
        if not spans[r.doc_id].spans:
            assert r.text == PERSONAL[r.doc_id]
        else:
            assert not brute_spans(r.text) and "<" in r.text


def test_tagger_learns_to_read_spans():
    rng = np.random.default_rng(0)

    def window(k):
        fill = " ".join(PROSE[i] for i in rng.integers(0, len(PROSE), 12))
        return f"{fill[:30]} a{k}.b@mail{k % 7}.example.com {fill[:25]}"[:96]

    train = [(w, [(k, s, e) for k, s, e in pii.base_spans(w)]) for w in map(window, range(300))]
    model = pii.trained(train)
    held = [window(k) for k in range(1000, 1040)]
    hits = sum(any((k, s, e) in pii.base_spans(t) for _, k, s, e in found) for t, found in zip(held, pii.tagged_spans(model, held)))
    assert hits >= 36


def test_spelled_out_addresses_without_digits_are_found(spark):
    rng = np.random.default_rng(4)
    name = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    fill = lambda: " ".join(PROSE[i] for i in rng.integers(0, len(PROSE), 6))[:28]
    texts = [f"{fill()} {name()}.{name()}@{name()}.example.org {fill()}" for _ in range(400)]
    asked = {}
    for k in range(20):
        spelled = f"{name()}.{name()} (at) {name()}.example.org"
        before = fill() + " "
        texts.append(f"{before}{spelled} {fill()}")
        asked[len(texts) - 1] = f"email:{len(before)}:{len(before) + len(spelled)}"
    texts += ["we met at home. Then we left", "look at kate.miller and that.thing", "nobody is at the (at) sign"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.base, r.spans) for r in pii.found(df).collect()}
    assert all(got[k][0] == "" for k in asked)
    assert sum(got[k][1] == span for k, span in asked.items()) >= 16
    assert got[420] == got[422] == ("", "")
    assert pii.windows_of("JANE [AT] MAIL.EXAMPLE.ORG") == pii.windows_of("jane at mail.org") == [0] and pii.windows_of("that mail.org, at home") == []


def test_tagger_gradients_are_those_of_its_loss():
    rng = np.random.default_rng(3)
    p = pii.initial(rng)
    x = rng.integers(0, pii.CLASSES, (2, 7))
    gold = np.array([pii._tags(7, [(1, 2, 5)]), pii._tags(7, [])])

    def loss(q):
        e = pii.emissions(q, x)[0]
        moves = q["t"] + pii.ALLOWED[: pii.TAGS]
        total = pii.marginals(e, moves)[2]
        path = sum(e[:, t][np.arange(2), gold[:, t]] + (moves[gold[:, t - 1], gold[:, t]] if t else 0) for t in range(7))
        return (total - path).mean()

    g = pii.gradients(p, x, gold)
    for name in p:
        at = tuple(s // 2 for s in p[name].shape)
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[name][at]) < 1e-4, name


# ------------------------------------------------------------- helpers


def test_components_of_a_chain_a_hub_and_a_cycle(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(1000, 1000 - k) for k in range(1, 300)] + [(5000, 5001), (5001, 5002), (5002, 5000), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    expected = {k: 1 for k in range(1, 61)} | {k: 701 for k in range(701, 1001)} | {k: 5000 for k in (5000, 5001, 5002)}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_sample_to_fit_is_bounded_and_the_same_again(spark):
    rows = spark.range(5000).repartition(7)
    first = {r.id for r in fit_sample(rows, 300, "id").collect()}
    assert 250 < len(first) <= 300
    assert {r.id for r in fit_sample(rows.repartition(2), 300, "id").collect()} == first
    assert fit_sample(rows.limit(20), 300, "id").count() == 20


# ------------------------------------------------------------- quality


def test_features_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    text = (prose(3, 1500) + "\n\n" + "AB# " * 700 + "  ").encode()
    whole = mil_quality.passages(text)
    monkeypatch.setattr(mil_quality, "BLOCK", 2)
    assert np.array_equal(mil_quality.passages(text), whole)
    for k, row in enumerate(whole):
        own = text.split()[64 * k:64 * (k + 1)]
        assert abs(row[-1] - (1 - len(set(own)) / len(own))) < 1e-6
    monkeypatch.setattr(simhash, "BLOCK", 10)
    assert simhash.fingerprint(text, 3) == brute_fingerprint(text.decode())


def test_scores_follow_the_labels_and_hold_out_rows(spark, docs, rows):
    junk = [(1000 + k, " ".join(f"{w}{'#$%&'[k % 4] * 3}" for w in prose(k, 80).split()), 0) for k in range(60)]
    good = [(2000 + k, prose(500 + k, 80), 1) for k in range(60)]
    more = spark.createDataFrame([(i, t) for i, t, _ in junk + good], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in junk + good] + [(None, 1), (1000, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in mil_quality.scored(docs.select("doc_id", "text").unionByName(more).where("doc_id is not null"), labels).collect()}
    for i, _, q in junk + good:
        held = zlib.crc32(str(i).encode()) % 4 == 2
        assert got[i].held_out == held
        assert got[i].predicted == q and 0 <= got[i].score <= 1
    assert mil_quality.scored(docs, labels).count() == len(rows)
    assert {r.score for r in mil_quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert mil_quality.scored(docs.limit(0), labels).count() == 0


def test_attention_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(5)
    p = mil_quality.initial(rng)
    x, first, y = rng.random((9, mil_quality.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    cost = np.array([1.0, 2.0, 0.5])

    def loss(q):
        s = mil_quality.forward(q, x, first)[0]
        return -(cost * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean()

    g = mil_quality.gradients(p, x, first, y, cost)
    for name in p:
        at = tuple(s // 2 for s in p[name].shape)
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert abs((loss(up) - loss(down)) / 2e-6 - g[name][at]) < 1e-5, name


# ------------------------------------------------------------- sharding


def test_shards_have_near_equal_bytes_and_gapless_slots(docs, rows):
    out = histogram_shards.shard_documents(docs, 4).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(r[:2] for r in rows)
    assert all(r["size"] == len((r.text or "").encode()) + 8 and r["group"] == "c" and r.slice == "d" for r in out)
    for shard in range(4):
        slots = [r.slot for r in out if r.shard == shard]
        assert sorted(slots) == list(range(len(slots)))
    total, most = sum(r["size"] for r in out), max(r["size"] for r in out)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) <= total / 4 + 2 * most


def test_a_large_group_of_copies_is_split_between_shards(spark):
    df = spark.createDataFrame([(k, "the same text " * 5) for k in range(900)] + [(1000 + k, prose(k, 12)) for k in range(300)], "doc_id long, text string")
    sizes = [r["sum(size)"] for r in histogram_shards.shard_documents(df, 6).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 6 and max(sizes) < 1.05 * min(sizes)


def test_shards_are_written_as_folders(spark, docs, tmp_path):
    histogram_shards.write_shards(docs, str(tmp_path / "shards"), 4)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={k}" for k in range(4)]
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def test_no_rows_no_shards(empty):
    assert histogram_shards.shard_documents(empty, 5).count() == 0


# ------------------------------------------------------------- licences


def test_whole_licence_files(spark):
    body = {n: t for n, t in license_digest.KNOWN if len(t) > 200}
    wrapped = lambda t: "\n\n".join(textwrap.fill(p, 70) for p in t.split("\n\n"))
    files = {
        "MIT": "The MIT License (MIT)\n\nCopyright (c) 2020 Foo\n\n", "ISC": "ISC License\n\nCopyright (c) Foo Inc.\n\n",
        "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright (c) 2019, Foo\nAll rights reserved.\n\n",
        "BSD-3-Clause": "Copyright 2019 Foo. All rights reserved.\n\n", "Zlib": "zlib License\n\n© Foo\n\n", "Unlicense": "", "0BSD": "Copyright by Foo\n\n",
    }
    assert set(files) == set(body)
    rows = [(k, head + wrapped(body[n]) + "\n", n) for k, (n, head) in enumerate(files.items())]
    rows += [(50, "MIT License\n\n" + wrapped(body["MIT"]).replace("free of charge", "for a fee"), None), (51, "MIT License\n", None), (52, "license\n" * 50, None)]
    rows += [(53, prose(3, 150_000) + "\nLicensed under the MIT License.\n" + "x" * 1_000_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string").withColumn("digest", F.lit("d")).withColumn("unit", F.lit("u"))
    got = {r.doc_id: r for r in license_digest.scanned(df).collect()}
    assert {k: r.text_license for k, r in got.items()} == {k: n for k, _, n in rows}
    assert got[53].line_licenses == "MIT" and got[53].n_license_lines == 1
    database = duckdb.connect()
    database.register("rows", df.select("doc_id", "text").toPandas())
    database.execute("CREATE TABLE documents AS SELECT * FROM rows")
    assert sorted(map(tuple, got.values())) == sorted(database.execute(license_digest.ORACLE).fetchall())
    twice = spark.createDataFrame([("A", "One text."), ("B", "one TEXT")], "license string, text string")
    assert license_digest.scanned(df.limit(1).withColumn("text", F.lit("One text")), known=twice).first().text_license == "A|B"


def test_licences_by_digest(spark):
    mit = next(t for n, t in license_digest.KNOWN if n == "MIT" and len(t) > 200)
    texts = [
        "Prose.\nLicenced under the APACHE licence, version 2.0!", "Copyright (c) 2020 Someone\n" + mit.upper(), mit.replace(" ", "\n"),
        "Licensed under the Apache License, Version 2.0 or later.", None, "", "...\n...", "Released under the MIT License.\nReleased under the MIT License.",
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, texts[0])], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in license_digest.scanned(df).collect()}
    assert got[0] == got[None] == (None, "Apache-2.0", 1)
    assert got[1][0] == got[2][0] == "MIT"
    assert got[3] == got[4] == got[5] == got[6] == (None, "", 0)
    assert got[7] == (None, "MIT", 2)
    assert license_digest.scanned(df.limit(0)).count() == 0
    assert license_digest.scanned(df, known=spark.createDataFrame([], "license string, text string")).where("n_license_lines > 0").count() == 0


# ------------------------------------------------------------- repeated passages


def brute_repeats(rows):
    """Results by (id, text); rows of one id and text are one document."""
    key = lambda r: (r[0] is None, r[0] or 0, hash_of(r[1]))
    seen, out = set(), {}
    for i, text in sorted(set(r[:2] for r in rows), key=key):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            window = tuple(w[s:s + 20])
            if window in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i, text] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def hash_of(text):
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_repeated_windows_go(docs, rows):
    expected = brute_repeats(rows)
    got = collected(suffix_dedup.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == sorted(((r[0], *expected[r[:2]]) for r in rows), key=repr)
    assert sum(r[2] for r in got) > 500


def test_repeats_with_small_groups_and_buckets(docs, rows, monkeypatch):
    for name, value in (("GROUP_ROWS", 40), ("BUCKET_BYTES", 2000), ("CHUNK_BYTES", 500)):
        monkeypatch.setattr(suffix_dedup, name, value)
    expected = brute_repeats(rows)
    got = collected(suffix_dedup.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == sorted(((r[0], *expected[r[:2]]) for r in rows), key=repr)


def test_heavy_prefixes_are_split_and_light_ones_packed():
    first, split = suffix_dedup.prefix_groups(np.array([3, 4, 50, 1, 0, 2]), rows=10)
    assert split.tolist() == [1, 1, 5, 1, 1, 1]
    assert first.tolist() == [0, 0, 1, 6, 6, 6]


def test_no_rows_no_repeats(empty):
    assert suffix_dedup.without_repeats(empty).count() == 0


# ------------------------------------------------------------- language model


def test_language_model_counts_and_probabilities(docs, rows):
    got = pitman_yor.scored(docs).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    train = Counter()
    for i, t, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    expected = []
    for i, t, *_ in rows:
        w = tokens(t)
        base = sum(np.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        expected.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(train[x] > 0 for x in w), n, round(base, 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert pitman_yor.scored(docs.limit(0)).count() == 0


def test_language_model_in_many_groups_and_chunks(docs, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): r for r in pitman_yor.scored(docs).collect()}
    monkeypatch.setattr(pitman_yor, "GROUP_TOKENS", 700)
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 3000)
    parts = pitman_yor.scored(docs).collect()
    assert len(parts) == len([r for r in docs.collect()])
    for r in parts:
        assert r.n_known == whole[r.doc_id, r.n_tokens].n_known
        assert abs(r.base_score - whole[r.doc_id, r.n_tokens].base_score) < 1e-6
        assert abs(r.score - whole[r.doc_id, r.n_tokens].score) < 0.05 * abs(r.score) + 0.5


def test_predictive_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    h = np.sort(rng.choice(np.arange(1, 1 << 20, dtype=np.uint64), 40, replace=False))
    pairs = sorted((int(x), int(c)) for x in h for c in rng.choice(5, 3, replace=False))
    n = rng.integers(1, 90, len(pairs))
    d = pitman_yor.Dishes.counted(np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs]), n)
    tables = np.bincount(d.context, minlength=pitman_yor.CONTEXTS)
    customers = np.bincount(d.context, weights=d.n, minlength=pitman_yor.CONTEXTS)
    shape = pitman_yor.Shape(int(n.sum()), 40, 0.7, 0.6)
    totals = [pitman_yor.Totals(tables, customers, 40.0, float(len(n)))]
    for _ in range(pitman_yor.SWEEPS):
        for t, c, r in d.sweeps(shape, totals, 1):
            pass
        totals.append(pitman_yor.Totals(np.bincount(d.context, weights=t, minlength=pitman_yor.CONTEXTS), customers, float(r.sum()), float(c.sum())))
        assert (t <= d.n).all() and (t >= 1).all() and (r <= c).all()
    scorer = pitman_yor.Scorer.of(d, shape, totals, 1)
    for context in range(5):
        asked = np.append(h, np.uint64(1 << 40))
        total = (10 ** scorer.score(asked, np.full(41, context, np.uint16))[1]).sum()
        assert abs(total - 1) < 1e-6


@pytest.mark.parametrize("hot", [1 / 20, pitman_yor.HOT])
def test_every_previous_word_is_a_context_of_its_own(spark, monkeypatch, hot):
    """Of two contexts that fall into one of 4,096 bins, neither lends its words to the other."""
    monkeypatch.setattr(pitman_yor, "HOT", hot)  # with the first, words are in groups; with the other, all are known to all
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10][:600]
    bins = {}
    for i in ids:
        bins.setdefault(xxhash.xxh3_64_intdigest(b"c%d" % i) * 0x9E3779B97F4A7C15 % (1 << 64) >> 52, []).append(i)
    a, b = next(x[:2] for x in bins.values() if len(x) > 1)
    asked = [f"c{a} w{a}", f"c{a} w{b}", f"c{a} nowhere", f"unseen w{a}", f"unseen w{b}", "unseen nowhere"]
    learnt = [(i, f"c{i} w{i}") for i in ids]
    number = [i for i in range(1000, 2000) if not zlib.crc32(str(i).encode()) % 10]  # held out
    docs = spark.createDataFrame([*learnt, *zip(number, asked)], "doc_id long, text string")
    by_id = {r.doc_id: r.score for r in pitman_yor.scored(docs).where("held_out").collect()}
    own, other, neither, own_p, other_p, neither_p = (by_id[i] for i in number[:len(asked)])
    gain = lambda x, p: (x - neither) - (p - neither_p)  # noqa: E731  (over the word's probability without context)
    assert abs(gain(other, other_p)) < 1e-9
    assert gain(own, own_p) > 1


def test_probabilities_in_other_contexts_add_up_to_one():
    rng = np.random.default_rng(3)
    h = np.sort(rng.choice(np.arange(1 << 40, 1 << 50, 1 << 20, dtype=np.uint64), 40, replace=False))
    said = np.append(np.arange(40), np.minimum(rng.geometric(0.1, 3000) - 1, 39))  # each word is followed by the next, the last by the first
    follows = np.roll(said, -1)
    order = pitman_yor.sorted_by(h[follows], pitman_yor.context_of(h[said]))
    d = pitman_yor.Dishes.counted(h[follows][order], pitman_yor.context_of(h[said])[order], np.ones(len(order), np.uint32))
    contexts, all_contexts = pitman_yor.Seats.among(d).contexts, pitman_yor.asked_of(d)
    tables_of = lambda t: np.bincount(np.searchsorted(all_contexts, d.context), weights=t)
    shape, none = pitman_yor.Shape(len(said), 40, 0.7, 0.6), np.zeros(pitman_yor.CONTEXTS)
    totals, cold, after = [pitman_yor.Totals(none, none, 40.0, float(len(d.n)))], [], [tables_of(np.ones(len(d.n)))]
    for _ in range(pitman_yor.SWEEPS):
        cold.append(after[-1][np.searchsorted(all_contexts, contexts)])
        for t, c, r in d.sweeps(shape, totals, 1, cold):
            pass
        totals.append(pitman_yor.Totals(none, none, float(r.sum()), float(c.sum())))
        after.append(tables_of(t))
    mean = sum(after[pitman_yor.BURN + 1:]) / (pitman_yor.SWEEPS - pitman_yor.BURN)
    scorer = pitman_yor.Scorer.of(d, shape, totals, 1, cold, mean)
    for k in range(40):
        asked = np.append(h, np.uint64(5))
        of_entry = scorer.score(asked, np.full(41, pitman_yor.context_of(h[k:k + 1])[0]))[1]
        assert abs((10 ** (of_entry + scorer.after[k])).sum() - 1) < 1e-6


def test_language_model_is_the_same_with_few_frequent_words(docs, monkeypatch):
    known_to_all = {(r.doc_id, r.n_tokens): r for r in pitman_yor.scored(docs).collect()}
    monkeypatch.setattr(pitman_yor, "HOT", 1 / 20)
    for r in pitman_yor.scored(docs).collect():
        other = known_to_all[r.doc_id, r.n_tokens]
        assert r.n_known == other.n_known and abs(r.base_score - other.base_score) < 1e-6
        assert abs(r.score - other.score) < 0.05 * abs(r.score) + 0.5


# ------------------------------------------------------------- near-duplicates


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(values, distance):
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(values)), 2):
        if bin(values[a] ^ values[b]).count("1") <= distance:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(values))]


@pytest.mark.parametrize("heavy", [simhash.HEAVY, 0])
def test_simhash_components(docs, rows, heavy):
    values = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(values, 3)
    names = {}
    for r, root in zip(rows, roots):
        names[root] = min([x for x in (names.get(root), r[0]) if x is not None], default=None)
    expected = sorted(((r[0], v, names[root]) for r, v, root in zip(rows, values, roots)), key=repr)
    got = simhash.near_duplicates(docs, heavy=heavy).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == expected


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_connect_what_is_near(spark, distance):
    rng = np.random.default_rng(distance)
    centers = rng.integers(0, 1 << 62, 12)
    values = {int(c) for c in centers}
    for c in centers:
        for _ in range(8):
            values.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
    values = sorted(values)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    expected = brute_components(values, distance)
    for heavy in (4096, 0):
        parts = simhash.plan(simhash.bit_counts(nodes), len(values), distance)
        assert sum(t + 1 for _, t in parts) == distance + 1
        edges = [(r.a, r.b) for r in simhash.links(nodes, distance, parts, heavy).collect()]
        place = {v: k for k, v in enumerate(signed)}
        root = list(range(len(values)))

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in edges:
            assert bin((a ^ b) % (1 << 64)).count("1") <= distance
            x, y = find(place[a]), find(place[b])
            root[max(x, y)] = min(x, y)
        assert [find(k) for k in range(len(values))] == expected


def test_one_row_of_each_component_stays(docs, rows):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [r.text for r in kept.collect()]
    roots = brute_components([brute_fingerprint(r[1]) for r in rows], 3)
    assert len(got) == len(set(roots))
    assert simhash.one_of_each(docs.limit(0)).count() == 0


# ------------------------------------------------------------- mixing


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weights.items() if s not in capped)
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * w / free for s, w in weights.items()}
        over = {s for s in target if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_meets_its_targets(docs, rows):
    got = pivotal_mix.copies(docs).withColumn("taken", F.col("copies") * F.col("size")).collect()
    sizes, most = Counter(), Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
        most[source] = max(most[source], len(words(text)))
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    assert sorted(r["size"] for r in got) == sorted(len(words(r[1])) for r in rows)
    by = {(i, hash_of(t)): s for i, t, _, s in rows}
    taken = Counter()
    for r in got:
        source = by[r.doc_id, r.text_key]
        taken[source] += r.taken
        assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6 and 0 <= r.copies <= 3
    for source, t in target.items():
        assert abs(taken[source] - t) <= most[source]
    again = pivotal_mix.copies(docs.repartition(5)).withColumn("taken", F.col("copies") * F.col("size"))
    assert collected(again) == collected(pivotal_mix.copies(docs).withColumn("taken", F.col("copies") * F.col("size")))


def test_mixed_rows_are_the_copies(docs):
    out = pivotal_mix.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == pivotal_mix.copies(docs).agg(F.sum("copies")).first()[0]
    assert pivotal_mix.mixed(docs.limit(0)).count() == 0


def test_rounding_keeps_the_expectation(spark):
    df = spark.createDataFrame([(k, "w " * (k % 9 + 1), f"s{k % 2}") for k in range(1000)], "doc_id long, text string, source string")
    rows = pivotal_mix.copies(df).collect()
    share = {r.source_size: r.target / r.source_size for r in rows}
    for size, f in share.items():
        own = [r.copies for r in rows if r.source_size == size]
        assert abs(sum(own) / len(own) - f) < 0.12


# ------------------------------------------------------------- quality rules


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    cover = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), len(re.findall("[A-Z]", text))


@pytest.mark.parametrize("text", ["", None, "a", "a b a b a b", "x y z\n\nx y z\n x y z", "é# <ü>|", "a a a a a", "q\x0bw\x0ce r t", "A b\nA b\nC"])
def test_rule_counts(text):
    assert robust_rules.counts_of((text or "").encode()) == brute_counts(text)


def test_rules_reject_outliers_and_keep_prose(docs, rows):
    got = robust_rules.judged(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        counts = brute_counts(r.text)
        assert tuple(r.rule_counts) == counts
        n, repeats = counts[0], counts[4]
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and r.doc_id < 100:
            assert r.kept == (n >= 50)
    odd = {r.doc_id: r.kept for r in got}
    assert not odd[204] and not odd[206]
    kept = robust_rules.passing(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert [r["kept"] for r in kept.select("kept").distinct().collect()] == ["b"]
    assert robust_rules.passing(docs.limit(0)).count() == 0


def test_scatter_ignores_a_fifth_of_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (2000, robust_rules.DIMS)) * 2 + 5
    x[:400] += 40
    stats = spark.createDataFrame([("en", "s", *map(float, r)) for r in x], "lang string, source string, " + ", ".join(f"{n} double" for n in robust_rules.X))
    for r in robust_rules.fit(stats).collect():
        assert np.abs(np.array(r.center) - 5).max() < 0.4


STATS = "lang string, source string, " + ", ".join(f"{n} double" for n in robust_rules.X)


def least_determinant(x, starts=60):
    """Least log determinant of concentration steps from random starts, over exact subsets."""
    rng, best = np.random.default_rng(1), np.inf
    keep, floors = int(np.ceil(robust_rules.SHARE * len(x))), np.diag(robust_rules.FLOORS**2)
    for _ in range(starts):
        rows = rng.choice(len(x), 2 * robust_rules.DIMS, replace=False)
        last = np.inf
        while True:
            center = x[rows].mean(axis=0)
            scatter = robust_rules.CONSISTENCY * np.cov(x[rows].T, bias=True) + floors
            now = np.linalg.slogdet(scatter)[1] if len(rows) == keep else np.inf
            if now >= last - 1e-6 and len(rows) == keep:
                break
            last, off = now, x - center
            rows = np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off))[:keep]
        best = min(best, last)
    return best


def test_determinant_is_the_least_of_many_random_starts(spark):
    rng = np.random.default_rng(4)
    groups = {}
    for k, n in enumerate((12, 60, 700)):
        mix = rng.normal(0, 1, (robust_rules.DIMS, robust_rules.DIMS))
        x = rng.normal(0, 1, (n, robust_rules.DIMS)) @ mix
        x[:n // 6] = rng.normal(0, 0.2, (n // 6, robust_rules.DIMS)) + 6  # a tight cluster of outliers
        groups[f"s{k}"] = x
    stats = spark.createDataFrame([("en", s, *map(float, r)) for s, x in groups.items() for r in x], STATS)
    got = {r.group: r for r in robust_rules.fit(stats).collect()}
    assert len(got) == 4
    for s, x in groups.items():
        r = got['{"lang":"en","source":"%s"}' % s]
        assert r.n == len(x)
        assert r.logdet <= least_determinant(x) + 0.25


def test_small_sources_have_norms_of_their_own(spark):
    tables = lambda k: " ".join(f"|{(k * 7 + j) % 97}|#{j}" for j in range(80))
    rows = [(k, prose(k, 80 + k % 50), "en", "books") for k in range(400)]
    rows += [(1000 + k, tables(k), "en", "tables") for k in range(40)] + [(2000, tables(5), "en", "books")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.kept for r in robust_rules.judged(docs).collect()}
    assert all(kept[k] for k in (*range(400), *range(1000, 1040))) and not kept[2000]


# ------------------------------------------------------------- decontamination


def test_templates_find_questions_with_other_values(spark):
    item = "A train leaves Paris at 5 pm and Alice Smith travels 120 km in 3 hours, how fast is it?"
    other = "Intro here. A train leaves Rome at 7 pm and Bobby Jones travels 90 miles in 4 hours, how fast is it? end"
    even = other.replace("Rome", "Jones")  # two names of the item are one here
    texts = [other, even, "so WHAT *is* two plus two!! then", "a train leaves paris", None, "", item.upper()]
    benchmark = spark.createDataFrame([(1, item), (2, "what is two plus two"), (3, None), (4, "too short")], "item_id long, text string")
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, item)], "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in templates.flagged(df, benchmark).collect()}
    assert got[0] == got[1] == got[6] == got[None] == [1] and got[2] == [2]
    assert got[3] == got[4] == got[5] == []
    rows = df.where("doc_id is not null").unionByName(spark.createDataFrame([
        (20, "It weighs 5 Kg and costs $1,200.50 for Anna O'Neil's 3rd McDonald visit, at 12:30 on 2020-01-02."), (21, "…  a. Paris, London (Berlin) 5km 5 km, 7 KM. x")],
        "doc_id long, text string"))
    more = benchmark.unionByName(spark.createDataFrame([(5, "it weighs 6 kg and costs 1,300.50 for Berta O'Neil's 3rd McDonald visit, at 13:30 on 2021-01-02")], "item_id long, text string"))
    database = duckdb.connect()
    for name, frame in (("documents", rows), ("benchmark", more)):
        database.register(f"{name}_rows", frame.toPandas())
        database.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    expected = {r[0]: (r[3], r[4]) for r in database.execute(templates.ORACLE).fetchall()}
    assert {r.doc_id: (",".join(map(str, r["items"])), r.n_windows) for r in templates.flagged(rows, more).collect()} == expected
    assert expected[20][0] == "5"
    assert templates.without_leaks(df, benchmark).where("doc_id in (0, 2) or doc_id is null").count() == 0
    assert templates.without_leaks(df, benchmark.limit(0)).count() == len(texts) + 1
    assert templates.flagged(df.limit(0), benchmark).count() == 0


def test_items_dense_in_numbers_are_found(spark):
    mean, total = "What is the mean of 3, 5, 7, 9, 11, 13 and 15?", "Find the sum of 12, 17, 23, 31, 45 and 58."
    numbers = "3 1 4 1 5 9 2 6 5 3 5 8"
    benchmark = spark.createDataFrame([(1, mean), (2, total), (3, numbers), (4, "2 4 6 8 10")], "item_id long, text string")
    texts = [
        "Now: " + mean + " Think.", "So find the sum of 2, 7, 3, 1, 5 and 8. Then", "What is the mean of 4, 6, 8, 10, 12, 14 and 16?", "0 " + numbers, "7 " * 40,
        "What is the mean of 4, 4, 8, 10, 12, 14 and 16?", "Find the sum of 2, 7, 3, 1, 5, 9 and 8.", "see 2 4 6 8 10 12",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r["items"], r.n_windows) for r in templates.flagged(df, benchmark).collect()}
    assert [got[k][0] for k in range(8)] == [[1], [2], [1], [3], [], [1], [], [4]]
    assert got[2][1] == 3 and got[3][1] == 5


def in_sql(documents, benchmark):
    """``items, n_windows`` by document, as the SQL has it."""
    database = duckdb.connect()
    for name, frame in (("documents", documents), ("benchmark", benchmark)):
        database.register(f"{name}_rows", frame.toPandas())
        database.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    return {r[0]: (r[3], r[4]) for r in database.execute(templates.ORACLE).fetchall()}


def test_marks_leave_ascii_texts_ascii_and_marks_in_texts_count_as_punctuation(spark):
    apples = "Tom has 5 apples. Ben has 7 pears. Who has more fruit now?"
    texts = [apples, "Ann has 8 \x01 apples. S\x02ue has 9\x03 pears.\x04 Who has more fruit now?", "Tom\ue000 has 5 app\x01les. B\x04en has \x037 pears. Who has more fruit now?"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, apples)], "item_id long, text string")
    assert df.select(templates.marked(F.col("text")).alias("t")).first().t.isascii()
    assert {r.doc_id: (",".join(map(str, r["items"])), r.n_windows) for r in templates.flagged(df, benchmark).collect()} == in_sql(df, benchmark)


def test_windows_are_joined_by_their_hash_alone(spark):
    """A string of every window as a second key of the join took most of the time."""
    item = "A train leaves Paris at 5 pm and Alice Smith travels 120 km in 3 hours, how fast is it?"
    df = spark.createDataFrame([(1, "Intro. " + item), (2, "nothing of it")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = templates.passages(df, benchmark)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"BroadcastHashJoin \[(.*?)\], \[(.*?)\], Inner", plan)
    assert joins and all(re.fullmatch(r"doc_h#\d+L", a) and re.fullmatch(r"h#\d+L", b) for a, b in joins)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1)}


def test_tokens_of_ascii_and_other_texts(spark):
    texts = ["", "  a\t\tb \n\r\x0b\x0c c  ", "-- x -- y!", "Él vio 5 Kg, y Óscar - no; ¡Sí!", "a\x00b c\x7fd e\u2014f \u00bd g", "so Rome, Paris. Berlin (seven) MILES two.five"]
    expected = ["", "a b c", "x y", "\x02él vio \x035 \x04kg y \x01óscar no \x02sí", "ab cd ef \x03½ \x04g", "so \x01rome \x01paris \x02berlin \x03seven \x04miles twofive"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    assert [r.t for r in df.orderBy("k").select(templates.marked(F.col("text")).alias("t")).collect()] == expected


def test_names_numbers_and_short_items_wherever_they_stand(spark):
    apples = "Tom has 5 apples. Ben has 7 pears. Who has more fruit now?"
    miles = "How long does a car need for sixty miles if it drives twenty miles in two hours?"
    twice = "If Anna gives 3 coins to Paul and Anna keeps 2 coins herself, what is left?"
    items = [(1, apples), (2, miles), (3, twice), (3, twice), (4, "Name it"), (5, "3 5 8 9 7 2 4 6 1"), (6, None), (7, "say it")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        ("Ann has 8 apples. Sue has 9 pears. Who has more fruit now?", [1]), ("so TOM HAS 5 APPLES. BEN HAS 7 PEARS. WHO HAS MORE FRUIT NOW?", [1]),
        ("How long does a car need for ninety miles if it drives 40 miles in three hours?", [2]),
        ("if Mary gives 4 coins to John and Mary keeps 4 coins herself, what is left?", [3]),
        ("if Mary gives 4 coins to John and Kate keeps 2 coins herself, what is left?", []),  # one name is two here
        ("NAME it!", [4]), ("name it all", []), ("say *it*", [7]), ("3 5 8 9 7 2 4 6 1", [5]), ("1 2 3 4 5 6 7 8 9", []),
        ("\ue000 \ue001x two \ue002", []), (None, []), ("", []), (("word " * 30_000) + apples + " x" * 1_000_000, [1]),
    ]
    rows = [(k, t, "a", "b", 1) for k, (t, _) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, w string, item_id string, n long")
    got = {r.doc_id: r for r in templates.flagged(df, benchmark).collect()}
    assert [got[k]["items"] for k in range(len(texts))] == [x for _, x in texts]
    short = df.where(F.length("text") < 1000).unionByName(df.where("text is null"))
    expected = in_sql(short, benchmark)
    assert {k: (",".join(map(str, got[k]["items"])), got[k].n_windows) for k in expected} == expected
    assert templates.without_leaks(df, benchmark).columns == df.columns


def test_templates_equal_the_sql_on_random_questions(spark):
    rng = np.random.default_rng(5)
    kinds = [["the", "is", "to", "and"], ["Ann", "Bob", "Eve"], ["3", "4", "two", "Five", "12,5"], ["km", "Hours", "(Rome)", "O'Neil", "so."]]

    def text(n):
        return " ".join(kinds[k][rng.integers(len(kinds[k]))] for k in rng.choice(4, n, p=[0.5, 0.15, 0.25, 0.1]))

    items = [text(int(rng.integers(1, 16))) for _ in range(40)]
    documents = [text(int(rng.integers(1, 120))) + " " + items[k % 40].lower() + " " + text(9) + " " + items[(7 * k) % 40].replace("Ann", "Joe") for k in range(120)]
    df = spark.createDataFrame(list(enumerate(documents)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = in_sql(df, benchmark)
    got = {r.doc_id: (",".join(map(str, r["items"])), r.n_windows) for r in templates.flagged(df, benchmark).collect()}
    assert got == expected and sum(n for _, n in expected.values()) > 500
    shuffled = {}
    with pytest.MonkeyPatch.context() as patch:  # a benchmark that is not proven small
        patch.setattr(templates, "broadcast_if_small", lambda frame, **_: (frame, False))
        shuffled = {r.doc_id: (",".join(map(str, r["items"])), r.n_windows) for r in templates.flagged(df, benchmark).collect()}
    assert shuffled == got


def test_a_text_full_of_passages_needs_no_more_memory_than_its_tokens(spark):
    """Each hit held all tokens of its text, 21 GB for this one, and each window of an item all tokens of the item."""
    item, book = " ".join(f"word{chr(97 + k)}" for k in range(24)), " ".join(f"w{k}x" for k in range(25_000))
    benchmark = spark.createDataFrame([(k, item) for k in range(3)], "item_id long, text string")
    df = spark.createDataFrame([(1, " ".join([item] * 850)), (2, "nothing of it"), (3, "so " + book)], "doc_id long, text string")
    got = {r.doc_id: (r["items"], r.n_windows) for r in templates.flagged(df, benchmark).collect()}
    assert got == {1: ([0, 1, 2], 51), 2: ([], 0), 3: ([], 0)}
    more = benchmark.unionByName(spark.createDataFrame([(3, book)], "item_id long, text string"))
    got = {r.doc_id: (r["items"], r.n_windows) for r in templates.flagged(df, more).collect()}
    assert got == {1: ([0, 1, 2], 51), 2: ([], 0), 3: ([3], 24_993)}


def test_passages_across_blocks_are_those_of_the_sql(spark):
    rng = np.random.default_rng(9)
    kinds = [["the", "is", "to", "and"], ["Ann", "Bob", "Eve"], ["3", "4", "two", "Five", "12,5"], ["km", "Hours", "(Rome)", "O'Neil", "so."]]

    def text(n, shares):
        return " ".join(kinds[k][rng.integers(len(kinds[k]))] for k in rng.choice(4, n, p=shares))

    plain, dense = [0.5, 0.15, 0.25, 0.1], [0.15, 0.1, 0.7, 0.05]
    items = [text(int(rng.integers(1, 30)), dense if k % 2 else plain) for k in range(24)] + ["Say it", "So"]
    documents = [" ".join([text(int(rng.integers(0, 40)), plain), items[k % 26], text(3, dense), items[(5 * k) % 26].lower(), items[(7 * k) % 26]]) for k in range(60)]
    df = spark.createDataFrame(list(enumerate([*documents, "say it", "so", "SAY it so"])), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = in_sql(df, benchmark)
    longer = templates.benchmark_windows(benchmark).where("is_long").count()
    for block, small in ((3, True), (16, True), (16, False)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(templates, "BLOCK", block)
            if not small:
                patch.setattr(templates, "broadcast_if_small", lambda frame, **_: (frame, False))
            got = {r.doc_id: (",".join(map(str, r["items"])), r.n_windows) for r in templates.flagged(df, benchmark).collect()}
        assert got == expected and longer > 20 and sum(n for _, n in expected.values()) > 500


def test_leaks_are_those_of_plain_windows_where_there_are_no_slots(spark, docs, rows):
    benchmark = spark.createDataFrame([(k, " ".join(words(rows[3 * k][1])[5 + k:20 + k][i].decode() for i in range(15))) for k in range(8)], "item_id long, text string")
    items = {r.item_id: r.text.replace(".", "").split() for r in benchmark.collect()}

    def leaks(text):
        w = [re.sub(r"\W", "", x.decode().lower()) for x in words(text)]
        windows = {tuple(w[k:k + 10]) for k in range(len(w) - 9)}
        return sorted(i for i, t in items.items() if any(tuple(t[k:k + 10]) in windows for k in range(6)))

    got = Counter((r.doc_id, tuple(r["items"])) for r in templates.flagged(docs, benchmark).collect())
    assert got == Counter((r[0], tuple(leaks(r[1]))) for r in rows)


# ------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, docs, data):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, data)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), data).count() == 0
        now = out
    assert now.count() > 0


def test_pipeline_rows_are_those_of_its_operators(spark, data):
    out = corpus_pipeline.run(spark, data).select("doc_id", "size", "shard", "slot").collect()
    table = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r for r in table.collect()}
    kept = {r.doc_id for r in robust_rules.judged(table).where("kept").collect()}
    order = sorted(kept)
    roots = brute_components([brute_fingerprint(texts[i].text) for i in order], 3)
    kept = {order[k] for k in roots}
    leaked = {r.doc_id for r in templates.flagged(table, spark.read.parquet(f"{data}/benchmark.parquet")).where("leaked").collect()}
    left = table.where(F.col("doc_id").isin(sorted(kept - leaked)))
    copies = {r.doc_id: r.copies for r in pivotal_mix.copies(left).collect() if r.copies}
    assert Counter(r.doc_id for r in out) == Counter(copies)
    assert all(r["size"] == len(texts[r.doc_id].text.encode()) + 8 for r in out)
