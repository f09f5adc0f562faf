"""Preparation, word ranking and the view on hand-written recordings."""

import pytest
from pyspark.sql import functions as F

from speechviews.operators import groups as G, prepare as P, serving as S, words as W
from speechviews.plans import batch_view as B
from speechviews.schemas import GROUP
from speechviews.sinks.tables import write_view
from speechviews.sources.tables import view_table

A = ("cpd", "zone1", "10:00:00", "2020-05-01")     # morn, spring
STOP = ["the", "and"]


def view(recordings, rows, stop=STOP):
    scored = P.grouped(recordings(rows)).withColumn("prediction", F.length("id") % 2)
    return B.view_of(scored, stop)


def test_quarantine_and_valid_split_the_rows(recordings):
    rows = [
        ("1", *A, "fine"), ("2", "cpd", None, "10:00:00", "2020-05-01", "x"), ("3", *A, None),
        ("4", "cpd", "z", "9:15", "2020-05-01", "x"), ("5", "cpd", "z", "10:00", "someday", "x"),
        (None, *A, "no id is fine"), ("7", "cpd", "z", "25:00:00", "2020-05-01", "late"),
    ]
    df = recordings(rows)
    assert {r.id for r in P.valid(df).collect()} == {"1", None, "7"}
    assert {(r.id, r.problem) for r in P.quarantined(df).collect()} == {
        ("2", "missing field"), ("3", "missing field"), ("4", "bad time"), ("5", "bad date"),
    }
    assert {r.id for r in P.valid(df, check_ranges=True).collect()} == {"1", None}
    assert P.drop_nulls(df).count() == 5


def test_rarest_five_and_overlap(recordings):
    counts = dict(zip(["aaa", "bbb", "ccc", "ddd", "eee", "fff", "ggg", "hhh", "iii", "jjj"], [5, 4, 4, 3, 3, 2, 2, 1, 1, 1]))
    text = " ".join(" ".join([w] * n) for w, n in counts.items())
    row = view(recordings, [("1", *A, text)]).first()
    assert row.most_common_words == "aaa,bbb,ccc,ddd,eee"
    assert row.least_common_words == "fff,ggg,hhh,iii,jjj"
    row = view(recordings, [("1", *A, "six five four three two1 one1")]).first()
    assert row.most_common_words == "five,four,one1,six,three"
    assert row.least_common_words == "four,one1,six,three,two1"


def test_text_without_words_still_counts(recordings):
    row = view(recordings, [("1", *A, "a an to"), ("2", *A, "the")]).first()
    assert (row.most_common_words, row.least_common_words, row.sentiment_score_total) == ("", "", 2)
    assert row.row_key == "cpdzone1mornspring"


def test_counts_of_view(recordings):
    rows = [("1", *A, "x y"), ("22", *A, "word"), ("333", *A, "word"), ("4", "cpd", "zone2", *A[2:], "other")]
    got = {r.zone: (r.sentiment_score_sum, r.sentiment_score_total) for r in view(recordings, rows).collect()}
    assert got == {"zone1": (2, 3), "zone2": (1, 1)}


@pytest.mark.parametrize("as_table", [False, True])
@pytest.mark.parametrize("listed", [STOP, [*STOP, "", None, "xy"], [*STOP, "", None, *(f"word{k}" for k in range(1200))]])
def test_stop_words_as_list_and_table(spark, recordings, as_table, listed):
    stop = spark.createDataFrame([(w,) for w in listed], "word string") if as_table else listed
    row = view(recordings, [("1", *A, "the cat and the hat The")], stop).first()
    assert row.most_common_words == "cat,hat"
    assert row.sentiment_score_total == 1


def test_large_stop_word_table_is_not_broadcast(spark, recordings, monkeypatch):
    stop = spark.createDataFrame([(w,) for w in [*STOP, ""]], "word string")
    monkeypatch.setattr(W, "broadcast_if_small", lambda df: (df, False))
    row = view(recordings, [("1", *A, "the cat and the hat"), ("2", *A, "the")], stop).first()
    assert (row.most_common_words, row.sentiment_score_total) == ("cat,hat", 2)


def test_broadcast_needs_a_proof(spark):
    from speechviews.session import broadcast_if_small

    words = spark.range(100).select(F.concat(F.lit("word"), F.col("id")).alias("word"))
    assert broadcast_if_small(words)[1]
    assert not broadcast_if_small(words, max_rows=99)[1]
    assert not broadcast_if_small(words, max_bytes=500)[1]


def test_word_counts_add_up(recordings):
    rows = [(str(i), "cpd", f"zone{i % 3}", *A[2:], "alpha beta beta gamma xx " * (i + 1)) for i in range(9)]
    grouped = P.grouped(recordings(rows))
    total = W.word_counts(grouped).agg(F.sum("cnt")).first()[0]
    assert total == W.words_of(grouped, "id").count() == 4 * 45


def test_only_few_words_of_a_group_are_sorted(spark):
    """Ties of counts on both sides, batches smaller than a group; rows that others beat are left out before the ranking."""
    words = spark.range(60_000, numPartitions=3).select(
        F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("group"),
        F.concat(F.lit("w"), F.hex(F.hash("id")), F.col("id").cast("string")).alias("word"),
        F.when(F.col("id") % 7 == 0, F.pmod(F.hash("id"), F.lit(50))).otherwise(F.lit(1)).cast("long").alias("cnt"),
    )
    totals = spark.createDataFrame([(f"g{k}", "", 1) for k in range(4)], "group string, word string, cnt long")
    counts = words.unionByName(totals).localCheckpoint()
    expected = set()
    by_group = {}
    for r in counts.collect():
        by_group.setdefault(r.group, []).append(r)
    for group, rows in by_group.items():
        order = sorted((r for r in rows if r.word), key=lambda r: (-r.cnt, r.word))
        expected |= {(group, "most", r.word, k + 1) for k, r in enumerate(order[:5])}
        expected |= {(group, "least", r.word, k + 1) for k, r in enumerate(order[::-1][:5])}
        expected.add((group, "all", "", 1))
    got = W.ranked(counts, by=["group"]).collect()
    assert {(r.group, r.side, r.word, r["rank"]) for r in got} == expected and len(got) == len(expected)
    left = W.hopefuls(counts, 5, "group")
    assert left.count() < 6_000 and left.where("word = ''").count() == 4


def test_ranking_matches_brute_force(spark, data):
    from collections import Counter, defaultdict

    from speechviews.catalogue import inputs as I

    counters = defaultdict(Counter)
    for r in P.prepare(I.recordings(spark, data)).collect():
        counters[tuple(r[c] for c in GROUP)].update(w for w in r.text.split(" ") if w and w not in I.STOP_WORDS)
    expected = {}
    for group, counter in counters.items():
        ordered = [w for w, _ in sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))]
        expected[group] = (",".join(ordered[:5]), ",".join(ordered[-5:]))
    got = {
        tuple(r[c] for c in GROUP): (r.most_common_words, r.least_common_words)
        for r in B.words_view(I.recordings(spark, data), I.STOP_WORDS).collect()
    }
    assert got == expected


def test_hot_group_is_cut_into_parts(recordings):
    rows = [(str(i), *A, f"text {i}") for i in range(200)] + [("x", "cpd", "zone2", *A[2:], "single")]
    parts = G.texts_per_group(P.grouped(recordings(rows)), rows_per_part=20).collect()
    hot = [p for p in parts if p.zone == "zone1"]
    assert sum(p.n_texts for p in hot) == 200 and len(hot) == 10 and max(p.n_texts for p in hot) < 60
    assert all(list(p.ids) == sorted(p.ids) for p in parts)
    assert {(i, t) for p in hot for i, t in zip(p.ids, p.texts)} == {(str(i), f"text {i}") for i in range(200)}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_texts_are_shuffled_once_by_group_and_part(spark, recordings, threshold):
    rows = [(str(i) if i % 3 else None, *A, f"text {i}") for i in range(200)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        parts = G.texts_per_group(P.grouped(recordings(rows)), rows_per_part=20)
        found = parts.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(p.n_texts for p in found) == 200 and max(p.n_texts for p in found) < 60
    plan = parts._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("part#" in line for line in shuffles) and "SortMergeJoin" not in plan


def test_many_groups_are_joined_in_slices(recordings, monkeypatch):
    rows = [(str(i), *A, f"text {i}") for i in range(200)]
    few = G.texts_per_group(P.grouped(recordings(rows)), rows_per_part=20).collect()
    monkeypatch.setattr(G, "broadcast_if_small", lambda df: (df, False))
    assert sorted(map(tuple, G.texts_per_group(P.grouped(recordings(rows)), rows_per_part=20).collect())) == sorted(map(tuple, few))


def test_first_plus_one_in_the_view_and_without_ids(recordings):
    rows = [(None, *A, "one two"), ("b", *A, "three"), ("a", *A, "four")]
    scored = P.grouped(recordings(rows)).withColumn("prediction", (F.col("id") == "a").cast("int"))
    assert G.sentiment_first_plus_one(scored).first().sentiment_score_sum == 2
    assert B.view_of(scored, STOP, score_mode="first_plus_one").first().sentiment_score_sum == 2
    nameless = scored.withColumn("id", F.lit(None).cast("string")).withColumn("prediction", F.lit(1))
    assert G.sentiment_first_plus_one(nameless).first().sentiment_score_sum == 2


def test_first_plus_one(recordings):
    scored = P.grouped(recordings([("b", *A, "x"), ("a", *A, "y")])).withColumn("prediction", (F.col("id") == "a").cast("int"))
    assert G.sentiment_first_plus_one(scored).first().sentiment_score_sum == 2
    assert G.sentiment_sums(scored).first().sentiment_score_sum == 1


def _view_rows(spark, rows):
    return spark.createDataFrame(
        [("".join(g), *g, most, least, s, t) for g, most, least, s, t in rows],
        "row_key string, dept_name string, zone string, time_of_day string, season string, most_common_words string, "
        "least_common_words string, sentiment_score_sum bigint, sentiment_score_total bigint",
    )


G1, G2, G3 = ("a", "bc", "morn", "fall"), ("ab", "c", "morn", "fall"), ("z", "z", "night", "fall")


def test_upsert_keeps_replaces_and_adds(spark):
    old = _view_rows(spark, [(G1, "x", "y", 1, 2), (G2, "x", "y", 3, 4)])
    new = _view_rows(spark, [(G2, None, "q", 5, 6), (G3, "n", "n", 7, 8)])
    got = {r.dept_name: (r.most_common_words, r.sentiment_score_total) for r in S.upsert(old, new).collect()}
    assert got == {"a": ("x", 2), "ab": (None, 6), "z": ("n", 8)}


def test_row_only_in_the_stream(spark):
    batch = _view_rows(spark, [(G1, "x", "y", 1, 2)])
    live = spark.createDataFrame([(*G1, 1, 1), (*G3, 0, 4)], "dept_name string, zone string, time_of_day string, season string, "
                                 "sentiment_score_sum bigint, sentiment_score_total bigint")
    got = {r.row_key: r for r in S.merge_counters(batch, live).collect()}
    assert (got["abcmornfall"].sentiment_score_sum, got["abcmornfall"].sentiment_score_total) == (2, 3)
    row = got["zznightfall"]
    assert (row.most_common_words, row.least_common_words, row.sentiment_score_total) == ("", "", 4)


def test_requests_join_on_columns_not_on_the_row_key(spark):
    batch = _view_rows(spark, [(G1, "one,two", "y", 1, 2), (G2, "other", "y", 0, 0)])
    requests = spark.createDataFrame([G1, G2, G3], "dept string, zone string, time_of_day string, time_of_year string")
    got = {r.dept_name: (r.most_common_words, r.percent_text) for r in S.answer_requests(requests, batch).collect()}
    assert got == {"a": ("one, two", "50.00%"), "ab": ("other", None), "z": (None, None)}


def test_view_versions(spark, tmp_path):
    path = str(tmp_path / "view")
    write_view(_view_rows(spark, [(G1, "x", "y", 1, 2)]), path, 1)
    first = view_table(spark, path)
    write_view(S.upsert(first, _view_rows(spark, [(G1, "z", "y", 9, 9)])), path, 2)
    assert view_table(spark, path).first().most_common_words == "z"
    assert view_table(spark, path, version=1).first().most_common_words == "x"
    row = S.lookup_group(view_table(spark, path), *G1)
    assert row.first().sentiment_score_total == 9
    assert "PartitionFilters: [isnotnull" in row._jdf.queryExecution().executedPlan().toString()


def test_append_adds_new_ids_only(recordings):
    source = recordings([("1", *A, "old")])
    landed = recordings([("1", *A, "again"), ("2", *A, "new"), ("3", *A, None)])
    assert [r.text for r in P.new_recordings(landed, source).collect()] == ["new"]


def test_appending_twice_changes_nothing(recordings):
    rows = [("1", *A, "a"), ("1", *A, "b"), (None, *A, "no id"), (None, *A, "no id"), (None, *A, "other")]
    source = recordings([("0", *A, "held"), (None, *A, "other")])
    added = P.new_recordings(recordings(rows), source)
    assert sorted(r.text for r in added.collect()) in (["a", "no id"], ["b", "no id"])
    assert P.new_recordings(recordings(rows), source.unionByName(added)).count() == 0


def test_rows_held_already_go_before_texts_are_shuffled(recordings):
    source = recordings([("1", *A, "old"), (None, *A, "old")])
    landed = recordings([("1", *A, "again"), ("1", *A, "again"), (None, *A, "old"), (None, *A, "old")])
    added = P.new_recordings(landed, source)
    plan = added._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("row_number") < plan.index("Join Left")  # the join is below the window
    assert added.count() == 0


def test_uploads(spark):
    uploads = spark.createDataFrame(
        [("cpd", "z", "2020-12-09", "14:30", "3", "", False), ("", "z", "2020-12-09", "14:30", "3", "t", False),
         ("cpd", "z", None, "14:30", "3", "t", True), ("cpd", "z", "2020-12-09", "14:30", "3", None, True)],
        "dept_name string, zone string, date string, time string, duration string, text string, recording boolean")
    assert P.valid_uploads(uploads).count() == 2
    assert P.rejected_uploads(uploads).count() == 2
    assert P.text_uploads(P.valid_uploads(uploads)).first().text is None


def test_csv_lines_without_multi_line(spark, tmp_path, recordings):
    from speechviews.sinks.tables import write_csv
    from speechviews.sources.tables import recordings_csv

    path = str(tmp_path / "csv")
    rows = [("1", *A, 'said "stop, now" \\ twice '), ("2", *A, " blank ends ")]
    write_csv(recordings(rows), path)
    assert sorted(tuple(r) for r in recordings_csv(spark, path).collect()) == sorted(
        (i, d, z, t, day, 1.0, text) for i, d, z, t, day, text in rows)


def test_torn_csv_lines_are_rejected_whole(spark, tmp_path, recordings):
    from speechviews.sinks.tables import write_csv
    from speechviews.sources.tables import recordings_csv, rejected_csv

    path = str(tmp_path / "csv")
    rows = [("1", *A, 'two\nlines "quoted"'), ("2", *A, "one, line"), ("3", *A, "a,b,c,d,e,1.0\nx")]
    write_csv(recordings(rows), path)
    assert [r.id for r in recordings_csv(spark, path).collect()] == ["2"]
    assert rejected_csv(spark, path).count() == 4
    assert {r.id: r.text for r in recordings_csv(spark, path, multi_line=True).collect()} == {r[0]: r[-1] for r in rows}


def test_broken_transcripts_are_kept(spark, tmp_path):
    from speechviews.schemas import TRANSCRIPT, with_corrupt_record
    from speechviews.sources.tables import rejected_json, transcripts_json

    (tmp_path / "a.json").write_text('{"jobName": "a", "results": {"transcripts": [{"transcript": "hi"}]}}\n')
    (tmp_path / "b.json").write_text("{broken\n")
    assert [(r.job_name, r.text) for r in transcripts_json(spark, str(tmp_path)).collect()] == [("a", "hi")]
    raw = spark.read.schema(with_corrupt_record(TRANSCRIPT)).json(str(tmp_path))
    assert [(r["_corrupt_record"], r.file_name) for r in rejected_json(raw).collect()] == [("{broken", "b.json")]


def test_catalog_table(spark, recordings):
    from speechviews.sources.tables import recordings_table

    recordings([("1", *A, "x")]).createOrReplaceTempView("landed")
    assert recordings_table(spark, "landed").columns[0] == "id"
