"""Every named query against its SQL, and the shape of the main plans."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (list, tuple)):
        return [comparable(v) for v in value]
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, database, name):
    df = QUERIES[name](spark, data)
    result = database.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    places = [columns.index(c) for c in df.columns]
    expected = sorted(([comparable(row[i]) for i in places] for row in result.fetchall()), key=repr)
    got = sorted(([comparable(v) for v in row] for row in df.collect()), key=repr)
    assert len(got) > 0
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_every_query_has_a_name_in_both_tables():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_reads_texts_once_and_limits_before_the_shuffle(spark, data):
    plan = plan_of(QUERIES["batch_view_labelled"](spark, data))
    assert plan.count("text#") > 0 and plan.count("FileScan parquet [doc_id") + plan.count("FileScan parquet [event_id") >= 1
    assert sum("documents.parquet" in line for line in plan.splitlines() if "FileScan" in line) == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["batch_view_words", "live_counts", "messages_deduped", "tfidf_terms", "texts_per_group"])
def test_no_python_in_the_plan(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_lookup_reads_one_partition_of_the_stored_view_and_no_text(spark, data):
    plan = plan_of(QUERIES["view_group_lookup"](spark, data))
    assert "PartitionFilters: [isnotnull" in plan and "documents.parquet" not in plan


def test_first_plus_one_reads_texts_once(spark, data):
    plan = plan_of(QUERIES["batch_view_first_plus_one"](spark, data))
    assert sum("documents.parquet" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_counting_segments_shuffles_no_text(spark, data):
    plan = plan_of(QUERIES["segment_counts"](spark, data))
    using_text = [line for line in plan.splitlines() if "text#" in line]
    assert using_text and all("FileScan" in line or "Filter" in line for line in using_text)


def test_a_view_written_twice_is_counted_once(spark, data, monkeypatch):
    from speechviews.catalogue import view

    for query, writer in ((view.view_as_catalog_table, "save_view_table"), (view.view_write_and_scan, "write_view")):
        plans, real = [], getattr(view, writer)

        def write(df, *args, real=real, plans=plans, **more):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            real(df, *args, **more)

        monkeypatch.setattr(view, writer, write)
        query(spark, data)
        assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans)
