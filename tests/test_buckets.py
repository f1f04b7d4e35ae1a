import datetime as dt

import pytest
from adloom.operators import buckets
from adloom.operators.latest import latest_raw, late_window
from adloom.operators.ledger import Ledger, Watch
from conftest import values

RAW = "date date, campaign_id string, clicks long, ingested_at timestamp, extract_run_id string"
AS_OF = "2024-01-20"


def batch(frame, run, campaigns, days):
    rows = [
        (dt.date(2024, 1, d), c and f"c{c}", 100 * run + d, dt.datetime(2024, 2, run), f"r{run}")
        for d in days
        for c in (*range(1, campaigns), None)
    ]
    return frame(rows, RAW)


@pytest.fixture()
def table(spark, folder):
    schema = f"buckets_{folder('x')[-12:]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder('schema')}'")
    return f"{schema}.raw"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_restatement_moves_no_row(spark, frame, table):
    buckets.append_bucketed(batch(frame, 1, 30, range(5, 21)), table, 4)
    buckets.append_bucketed(batch(frame, 2, 20, range(13, 21)), table)
    got = buckets.restated(spark, table, AS_OF)
    assert shuffles(got) == 0
    assert "PartitionFilters: [isnotnull(date" in got._jdf.queryExecution().executedPlan().toString()
    want = latest_raw(late_window(batch(frame, 1, 30, range(5, 21)).union(batch(frame, 2, 20, range(13, 21))), AS_OF))
    columns = RAW.replace(" date,", ",").split(", ")
    names = [c.split()[0] for c in columns]
    assert values(got, *names) == values(want, *names)


def test_restated_days_replace_the_stored_ones(spark, frame, table, folder):
    watch = Watch(Ledger(spark, folder("ledger")), {"raw": None})
    first, second = batch(frame, 1, 30, range(5, 21)), batch(frame, 2, 20, range(13, 21))
    assert buckets.append_bucketed(first, table, 4, watch) == 16 * 30
    assert buckets.append_bucketed(second, table, watch=watch) == 8 * 20
    assert buckets.restate_bucketed(spark, table, AS_OF, watch) == 8 * 30
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 16 * 30
    assert spark.table(table).where("extract_run_id = 'r2'").count() == 8 * 20
    assert not watch.ledger.audit({"raw": (spark.table(table), None, "date")}).where("differ").count()
    # Still bucketed, one file for each bucket and day, and restated again without a change.
    files = spark.table(table).where("date >= date'2024-01-13'").select("_metadata.file_path", "date").distinct()
    assert files.count() <= 8 * 4
    assert shuffles(buckets.restated(spark, table, AS_OF)) == 0
    again = values(buckets.restated(spark, table, AS_OF).select("date", "campaign_id", "clicks"))
    assert again == values(spark.table(table).where("date >= date'2024-01-13'").select("date", "campaign_id", "clicks"))


def test_other_tables_and_empty_batches(spark, frame, table):
    assert buckets.append_bucketed(frame([], RAW), table, 4) == 0
    assert buckets.bucket_count(spark, table) == 4
    assert buckets.restated(spark, table, AS_OF).count() == 0
    spark.sql(f"CREATE TABLE {table}_plain USING parquet AS SELECT 1 AS x")
    with pytest.raises(ValueError, match="isn't bucketed"):
        buckets.bucket_count(spark, f"{table}_plain")
