import datetime as dt

import pytest
from adloom import schemas as S
from adloom.operators import volume, writes
from adloom.operators.catalog import create_namespaces
from adloom.operators.ledger import PAIRS, Ledger, Watch
from adloom.plans import daily
from adloom.sources.tables import scan
from adloom.streaming.ingest import batch_run_id
from conftest import values
from pyspark.sql import functions as F

RAW = "date date, campaign_id string, ingested_at timestamp, extract_run_id string, clicks long"


def day(n):
    return dt.date(2024, 1, n)


def row(d, campaign, at, run="r", clicks=1):
    return (d and day(d), campaign, at and dt.datetime(2024, 2, at, 5), run, clicks)


@pytest.fixture(params=["folder", "table"])
def kept(request, spark, folder):
    """A raw target, its ledger and what the writers note."""
    if request.param == "folder":
        names = folder("raw"), folder("ledger")
    else:
        schema = f"ledger_{folder('x')[-12:]}"
        spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder('schema')}'")
        names = f"{schema}.raw", f"{schema}.ledger"
    ledger = Ledger(spark, names[1])
    complete = F.col("date").isNotNull() & F.col("campaign_id").isNotNull()
    return names[0], ledger, Watch(ledger, {"raw": None, "stg": complete})


def agrees(ledger, watch, stored):
    audited = ledger.audit({n: (stored, c, watch.day) for n, c in watch.tables.items()}).collect()
    assert audited and not [r for r in audited if r.differ]
    return {(r.table_name, r.day, r.ingestion_day): r.ledger_rows for r in audited}


def test_every_writer_keeps_the_ledger(spark, frame, kept):
    target, ledger, watch = kept
    first = [row(1, "a", 1), row(1, "b", 1), row(2, "a", 1), row(2, None, 1), row(None, "c", 1), row(3, "a", None)]
    writes.append_raw(frame(first, RAW), target, watch=watch)
    counts = agrees(ledger, watch, scan(spark, target))
    assert counts["raw", None, dt.date(2024, 2, 1)] == 1 and counts["raw", day(3), None] == 1
    assert counts["raw", day(2), dt.date(2024, 2, 1)] == 2 and counts["stg", day(2), dt.date(2024, 2, 1)] == 1
    writes.append_raw(frame([row(1, "a", 2), row(2, "a", 2), row(None, "c", 2)], RAW), target, watch=watch)
    agrees(ledger, watch, scan(spark, target))
    writes.dedup_days(spark, target, watch=watch)
    counts = agrees(ledger, watch, scan(spark, target))
    assert counts["raw", day(1), dt.date(2024, 2, 1)] == counts["raw", day(1), dt.date(2024, 2, 2)] == 1
    writes.replace_partitions(frame([row(2, "z", 3), row(2, "y", 3)], RAW), target, watch=watch)
    counts = agrees(ledger, watch, scan(spark, target))
    assert ("raw", day(2), dt.date(2024, 2, 1)) not in counts
    for _ in range(2):  # a batch that is repeated
        run = batch_run_id("s", 4)
        writes.replace_run(frame([row(1, "n", 4, run), row(5, "n", 4, run)], RAW), run, target, watch)
        counts = agrees(ledger, watch, scan(spark, target))
        assert counts["raw", day(1), dt.date(2024, 2, 4)] == 1
    writes.append_raw(frame([], RAW), target, watch=watch)
    agrees(ledger, watch, scan(spark, target))


def test_a_write_that_was_not_noted_is_found_and_mended(spark, frame, kept):
    target, ledger, watch = kept
    writes.append_raw(frame([row(1, "a", 1), row(2, "a", 1)], RAW), target, watch=watch)
    writes.append_raw(frame([row(1, "b", 1), row(2, "b", 1)], RAW), target)
    audit = lambda: ledger.audit({"raw": (scan(spark, target), None, "date")}).where("differ")
    assert values(audit(), "day", "ledger_rows", "stored_rows") == [(day(1), 1, 2), (day(2), 1, 2)]
    # The next write of a day mends that day, a recount all of them.
    writes.replace_partitions(frame([row(1, "c", 2)], RAW), target, watch=watch)
    assert values(audit(), "day") == [(day(2),)]
    ledger.settle(watch, scan(spark, target))
    agrees(ledger, watch, scan(spark, target))


def test_more_pairs_of_days_than_are_counted_exactly(spark, frame, folder, monkeypatch):
    monkeypatch.setattr("adloom.operators.ledger.PAIRS", 3)
    target, ledger = folder("raw"), Ledger(spark, folder("ledger"))
    watch = Watch(ledger, {"raw": None})
    rows = [row(d, "a", at) for d in (1, 2, 3, 4) for at in (1, 2, 3)]
    writes.append_raw(frame(rows, RAW).repartition(3), target, watch=watch)
    assert len(agrees(ledger, watch, scan(spark, target))) == 12
    assert PAIRS > 10_000


def test_days_of_any_year(spark, frame, folder):
    target, ledger = folder("raw"), Ledger(spark, folder("ledger"))
    watch = Watch(ledger, {"raw": None})
    odd = [(dt.date(y, 3, 1), "a", dt.datetime(y, 3, 2), "r", 1) for y in (1, 1582, 1969, 9999)]
    writes.append_raw(frame(odd, RAW), target, watch=watch)
    assert {k[1].year for k in agrees(ledger, watch, scan(spark, target))} == {1, 1582, 1969, 9999}


def test_a_ledger_can_be_compacted(spark, frame, kept):
    target, ledger, watch = kept
    for at in (1, 2, 3):
        writes.replace_partitions(frame([row(1, "a", at)], RAW), target, watch=watch)
    if "/" in ledger.target:
        return
    before = ledger.entries().count()
    assert writes.compact_ledger(ledger) == 2 < before
    agrees(ledger, watch, scan(spark, target))


def test_day_counts_and_history(spark, frame, folder):
    target, ledger = folder("raw"), Ledger(spark, folder("ledger"))
    watch = Watch(ledger, {"raw": None})
    rows = [row(d, "a", at) for d, at in ((1, 1), (2, 1), (3, 2), (4, 4), (5, 4), (6, 4))]
    writes.append_raw(frame(rows, RAW), target, watch=watch)
    assert values(ledger.day_counts(["raw", "other"], "2024-02-02")) == [("other", 0, 0, None), ("raw", 1, 2, None)]
    history = values(volume.ledger_history(ledger, "2024-02-01", "2024-02-04"), "day", "row_count", "previous_count", "variance_percent")
    assert [h[1:] for h in history] == [(2, None, 0.0), (1, 2, 50.0), (0, 1, 100.0), (3, 0, 0.0)]


def test_the_volume_step_reads_no_model_table(spark, frame, folder, monkeypatch):
    names = {layer: f"{layer}_{folder('x')[-12:]}" for layer in ("raw", "staging", "intermediate", "marts")}
    create_namespaces(spark, names, folder("schemas"))
    layers = daily.Layers(names)
    google = frame([(day(29), f"c{i}", "n", 10, 2, 1, 1.0) for i in range(20)], S.GOOGLE_RECORD)
    meta = frame([(day(29), "m", "n", 10, 2, None, 1.0, 1, 1, 1, 1, 1)], S.META_RECORD)
    plans = []
    evaluate = volume.evaluate
    monkeypatch.setattr(volume, "evaluate", lambda counts, limits: plans.append(counts.inputFiles()) or evaluate(counts, limits))
    for run in (1, 2):
        log = daily.run_daily(spark, google, meta, layers, "2024-01-30", f"r{run}", f"2024-01-30T0{run}:00:00Z").first()
        assert (log.status, log.volume_check_tables_checked) == ("success", 5)
        assert log.volume_check_tables_failed == 1  # one row of the Meta side is too few
    assert plans and all("ingestion_ledger" in file for files in plans for file in files)
    assert not daily.audit_ledger(spark, layers).where("differ").collect()
    lost = volume.ledger_counts(Ledger(spark, layers.ledger), {"gone": lambda: spark.table("gone.gone")})
    assert "TABLE_OR_VIEW_NOT_FOUND" in lost.first()["error"]
    # A deployment without a ledger is counted once.
    spark.sql(f"DROP TABLE {layers.ledger}")
    daily.run_daily(spark, google, meta, layers, "2024-01-30", "r3", "2024-01-30T03:00:00Z")
    assert not daily.audit_ledger(spark, layers).where("differ").collect()
