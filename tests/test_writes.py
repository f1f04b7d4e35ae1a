import datetime as dt
import time
import uuid
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.operators.ledger import Ledger, Watch
from adloom.operators import catalog, runlog, writes
from adloom.operators.latest import restate
from adloom.plans import analysis, daily, mart
from adloom.sources.tables import scan, scan_as
from conftest import values


def raw(frame, *rows):
    ddl = "date date, campaign_id string, clicks long, ingested_at timestamp, extract_run_id string"
    return frame(
        [(dt.date(2024, 1, d), c, n, dt.datetime(2024, 2, 1, h), f"r{h}") for d, c, n, h in rows], ddl
    )


@pytest.fixture(params=["path", "table"])
def target(request, spark, folder):
    if request.param == "path":
        return folder("table")
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    return f"{name}.t"


def kept(spark, target):
    return values(scan(spark, target), "date", "campaign_id", "clicks")


def day(n):
    return dt.date(2024, 1, n)


def test_append_creates_then_adds(spark, frame, target):
    assert writes.append_raw(raw(frame, (1, "a", 1, 1), (2, "a", 2, 1)), target) == 2
    assert writes.append_raw(raw(frame, (1, "a", 3, 2)), target) == 1
    assert kept(spark, target) == [(day(1), "a", 1), (day(1), "a", 3), (day(2), "a", 2)]


def test_empty_batch_changes_no_rows(spark, frame, target):
    some = raw(frame, (1, "a", 1, 1))
    assert writes.append_raw(some.where("false"), target) == 0
    assert writes.append_raw(some, target) == 1
    assert writes.append_raw(some.where("false"), target) == 0
    assert writes.replace_partitions(some.where("false"), target) == 0
    assert kept(spark, target) == [(day(1), "a", 1)]


@pytest.mark.parametrize("write", [writes.append_raw, writes.replace_partitions])
def test_a_write_computes_its_input_once(spark, frame, target, write):
    writes.append_raw(raw(frame, (1, "a", 1, 1)), target)
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    some = raw(frame, (2, "b", 2, 1), (3, "c", 3, 1))
    assert write(some.mapInArrow(count, some.schema), target) == 2
    assert computed.value == 2


def test_replacing_days_leaves_other_days(spark, frame, target):
    writes.append_raw(raw(frame, (1, "a", 1, 1), (2, "a", 2, 1)), target)
    for _ in range(2):
        assert writes.replace_partitions(raw(frame, (2, "a", 9, 2), (2, "b", 8, 2)), target) == 2
        assert kept(spark, target) == [(day(1), "a", 1), (day(2), "a", 9), (day(2), "b", 8)]


def test_restated_days_replace_the_stored_ones(spark, frame, target):
    writes.append_raw(raw(frame, (1, "a", 1, 1), (9, "a", 2, 1), (9, "b", 3, 1)), target)
    fresh = restate(scan(spark, target), raw(frame, (9, "a", 7, 2)), "2024-01-10")
    writes.replace_partitions(fresh, target)
    assert kept(spark, target) == [(day(1), "a", 1), (day(9), "a", 7), (day(9), "b", 3)]


def test_a_repeated_run_replaces_its_own_rows(spark, frame, target):
    assert writes.replace_run(raw(frame, (1, "a", 1, 1), (3, "a", 1, 1)), "r1", target) == 2
    for _ in range(2):
        assert writes.replace_run(raw(frame, (1, "a", 2, 2)), "r2", target) == 2
    assert kept(spark, target) == [(day(1), "a", 1), (day(1), "a", 2), (day(3), "a", 1)]
    assert writes.compact_days(spark, target) == 3
    assert writes.dedup_days(spark, target) == 1
    assert writes.append_raw(raw(frame, (1, "b", 5, 3)), target) == 1
    assert kept(spark, target) == [(day(1), "a", 2), (day(1), "b", 5), (day(3), "a", 1)]


def test_dedup_rewrites_only_days_with_repeats(spark, frame, target, folder):
    writes.append_raw(raw(frame, (1, "a", 1, 1), (2, "a", 1, 1), (2, "a", 5, 3), (2, "a", 4, 2)), target)
    copy = folder("copy")
    assert writes.dedup_days(spark, target, copy) == 1
    assert kept(spark, target) == [(day(1), "a", 1), (day(2), "a", 5)]
    assert values(scan(spark, copy), "date") == [(day(2),)]
    again = folder("copy")
    assert writes.dedup_days(spark, target, again) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan(spark, again)


def test_an_interrupted_replacement_can_be_completed(spark, frame, folder, monkeypatch):
    target, copy = folder("table"), folder("copy")
    writes.append_raw(raw(frame, (1, "a", 1, 1), (1, "a", 2, 2)), target)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(writes, "replace_partitions", broken)
        with pytest.raises(RuntimeError):
            writes.dedup_days(spark, target, copy)
    assert len(kept(spark, target)) == 2
    writes.replace_partitions(scan(spark, copy), target)
    assert kept(spark, target) == [(day(1), "a", 2)]


def test_rows_without_a_day_are_deduplicated_too(spark, frame, target):
    rows = raw(frame, (1, "a", 1, 1), (1, "a", 2, 2)).withColumn("date", F.lit(None).cast("date"))
    writes.append_raw(rows, target)
    assert writes.dedup_days(spark, target, schema=rows.schema) == 1
    assert values(scan(spark, target, rows.schema), "date", "clicks") == [(None, 2)]


@pytest.fixture()
def mart_rows(spark):
    def make(n, last=10):
        base = spark.range(n).select(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % last).cast("int")).alias("report_date"),
            F.col("id").cast("string").alias("campaign_id"),
            F.when(F.col("id") % 3 == 0, S.META).otherwise(S.GOOGLE).alias("platform"),
            F.col("id").alias("clicks"),
        )
        return base
    return make


def test_mart_is_replaced_as_a_whole(spark, target, mart_rows):
    assert writes.write_mart(mart_rows(100), target) == 100
    assert writes.write_mart(mart_rows(30), target) == 30
    assert scan(spark, target).count() == 30
    assert values(scan(spark, target), "campaign_id", "clicks") == sorted(
        [(str(i), i) for i in range(30)], key=str)


def test_mart_days_can_be_refreshed(spark, target, mart_rows):
    writes.write_mart(mart_rows(100), target)
    changed = mart_rows(100).where("report_date = '2024-01-03'").withColumn("clicks", F.lit(-1).cast("long"))
    writes.refresh_mart(changed, target)
    assert scan(spark, target).count() == 100
    assert scan(spark, target).where("clicks = -1").count() == 10


def test_mart_files_are_sorted_and_partitioned_by_day(spark, folder, mart_rows):
    target = folder("mart")
    writes.write_mart(mart_rows(300), target)
    stored = spark.read.parquet(target)
    per_file = stored.select("*", F.col("_metadata.file_path").alias("f")).toPandas()
    for _, part in per_file.groupby("f", sort=False):
        assert part["report_date"].nunique() == 1
        keys = list(zip(part["platform"], part["campaign_id"]))
        assert keys == sorted(keys)


def test_a_swap_may_read_the_table_it_replaces(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    table = f"{name}.t"
    writes.append_raw(raw(frame, (1, "a", 1, 1), (2, "a", 2, 1)), table)
    writes.swap_in(spark.table(table).where("clicks = 2"), table, ("date",))
    assert kept(spark, table) == [(day(2), "a", 2)]
    writes.append_raw(raw(frame, (2, "b", 3, 1)), table)
    assert kept(spark, table) == [(day(2), "a", 2), (day(2), "b", 3)]


def test_a_failed_swap_leaves_the_table(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    table = f"{name}.t"
    writes.append_raw(raw(frame, (1, "a", 1, 1)), table)
    failing = spark.table(table).withColumn("clicks", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        writes.swap_in(failing, table, ("date",))
    assert kept(spark, table) == [(day(1), "a", 1)]


def test_a_swap_interrupted_between_renames_is_undone(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    table = f"{name}.t"
    writes.append_raw(raw(frame, (1, "a", 1, 1)), table)
    writes._rename(spark, table, f"{table}__previous")
    writes.recover_table(spark, table)
    assert kept(spark, table) == [(day(1), "a", 1)]
    writes.recover_table(spark, table)
    assert kept(spark, table) == [(day(1), "a", 1)]


@pytest.mark.parametrize("external", [False, True])
def test_a_swap_that_crashes_anywhere_keeps_old_or_new_rows(spark, frame, folder, monkeypatch, external):
    """A crash after each statement and each deletion, then recovery."""
    old, new = [(day(1), "a", 1), (day(2), "b", 2)], [(day(3), "c", 3)]
    at, ended = 0, False
    run_sql, delete = type(spark).sql, writes._delete
    while not ended:
        name = f"s_{uuid.uuid4().hex[:8]}"
        catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
        table = f"{name}.t"
        first = raw(frame, (1, "a", 1, 1), (2, "b", 2, 1))
        if external:
            writes.swap_in(first, table, ("date",))
        else:
            writes.append_raw(first, table)
        left = [at]

        def counted(done, *args, **kwargs):
            result = done(*args, **kwargs)
            left[0] -= 1
            if left[0] < 0:
                raise ConnectionError("driver lost")
            return result

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", lambda *a, **k: counted(run_sql, *a, **k))
            patch.setattr(writes, "_delete", lambda *a, **k: counted(delete, *a, **k))
            try:
                writes.swap_in(raw(frame, (3, "c", 3, 1)), table, ("date",))
                ended = True
            except ConnectionError:
                pass
        writes.recover_table(spark, table)
        assert kept(spark, table) in ([new] if ended else [old, new]), at
        assert not spark.catalog.tableExists(f"{table}__previous")
        at += 1
    assert at > 5


def test_an_incomplete_table_never_costs_the_old_one(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    table = f"{name}.t"
    writes.append_raw(raw(frame, (1, "a", 1, 1)), f"{table}__previous")
    writes.append_raw(raw(frame, (1, "a", 1, 1)).where("false"), table)
    with pytest.raises(RuntimeError, match="__previous"):
        writes.recover_table(spark, table)
    assert kept(spark, f"{table}__previous") == [(day(1), "a", 1)]


def test_a_folder_of_the_mart_survives_a_failed_build(spark, folder, mart_rows):
    target = folder("mart")
    writes.write_mart(mart_rows(20), target)
    failing = mart_rows(5).withColumn("clicks", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        writes.write_mart(failing, target)
    assert scan(spark, target).count() == 20
    path, files = writes._path(spark, target)
    files.rename(path, writes._path(spark, f"{target}__previous")[0])
    writes.recover_folder(spark, target)
    assert scan(spark, target).count() == 20


class Unwilling:
    """A file system whose renames fail from the n-th on, by their answer or half-way."""

    def __init__(self, files, spark, from_, halfway):
        self.files, self.spark, self.left, self.halfway = files, spark, from_, halfway

    def __getattr__(self, name):
        return getattr(self.files, name)

    def rename(self, old, new):
        self.left -= 1
        if self.left >= 0:
            return self.files.rename(old, new)
        if self.halfway:
            # As where a rename copies: some of the files are there, the old folder is whole.
            some = scan(self.spark, old.toString()).limit(2)
            some.write.partitionBy("report_date").parquet(new.toString())
        return False


@pytest.mark.parametrize("halfway", [False, True])
@pytest.mark.parametrize("from_", [0, 1])
def test_renames_that_fail_never_cost_the_mart(spark, folder, mart_rows, monkeypatch, from_, halfway):
    target = folder("mart")
    writes.write_mart(mart_rows(20), target)
    path = writes._path
    unwilling = Unwilling(path(spark, target)[1], spark, from_, halfway)
    monkeypatch.setattr(writes, "_path", lambda s, f: (path(s, f)[0], unwilling))
    with pytest.raises(Exception, match="could not be renamed|is there already"):
        writes.write_mart(mart_rows(7), target)
    monkeypatch.undo()
    writes.recover_folder(spark, target)
    assert scan(spark, target).count() == 20
    assert writes.write_mart(mart_rows(7), target) == 7
    assert scan(spark, target).count() == 7
    assert not path(spark, target)[1].exists(path(spark, f"{target}__previous")[0])


@pytest.mark.parametrize("steps", range(1, 9))
def test_a_crash_after_any_step_leaves_the_old_or_the_new_folder(spark, folder, mart_rows, monkeypatch, steps):
    target = folder("mart")
    writes.write_mart(mart_rows(20), target)
    path, left = writes._path, [steps]

    class Crashing:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            done = getattr(self.files, name)

            def step(*given):
                left[0] -= name in ("rename", "delete", "exists")
                if left[0] < 0:
                    raise KeyboardInterrupt
                return done(*given)

            return step

    monkeypatch.setattr(writes, "_path", lambda s, f: (path(s, f)[0], Crashing(path(s, f)[1])))
    try:
        writes.write_mart(mart_rows(7), target)
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    writes.recover_folder(spark, target)
    assert scan(spark, target).count() in (20, 7)
    assert writes.write_mart(mart_rows(9), target) == 9


def test_a_folder_of_unknown_state_is_left_alone(spark, folder, mart_rows):
    target = folder("mart")
    writes.write_mart(mart_rows(20), target)
    mart_rows(4).write.partitionBy("report_date").parquet(f"{target}__previous")
    with pytest.raises(RuntimeError, match="isn't noted"):
        writes.recover_folder(spark, target)
    assert scan(spark, target).count() == 20 and scan(spark, f"{target}__previous").count() == 4


def test_a_run_without_a_source(spark, frame, folder):
    names = {layer: f"{n}_{uuid.uuid4().hex[:8]}" for layer, n in catalog.LAYERS.items()}
    catalog.create_namespaces(spark, names, folder("schemas"))
    layers = daily.Layers(names)
    google = frame([(day(1), "g", "G", 100, 10, 2, 5.0)], S.GOOGLE_RECORD)
    meta = frame([], S.META_RECORD)
    row = daily.run_daily(spark, google, meta, layers, "2024-01-02", "r1", "2024-01-02T00:00:00Z").first()
    assert (row["status"], row["google_ads_extracted_count"], row["meta_ads_extracted_count"]) == ("success", 1, 0)
    assert spark.table(layers.mart).count() == 1


def test_namespaces(spark, folder):
    names = {layer: f"{n}_{uuid.uuid4().hex[:8]}" for layer, n in catalog.LAYERS.items()}
    assert catalog.missing_namespaces(spark, names).count() == 4
    catalog.create_namespaces(spark, {k: names[k] for k in ("raw", "marts")}, folder("schemas"))
    assert values(catalog.missing_namespaces(spark, names)) == sorted(
        [(names["staging"],), (names["intermediate"],)])
    catalog.create_namespaces(spark, names, folder("schemas"))
    assert catalog.missing_namespaces(spark, names).count() == 0


def test_schema_names_are_taken_as_given():
    assert catalog.schema_name(" custom ") == "custom"
    assert catalog.schema_name(None, "target") == "target"
    assert catalog.qualified("t", "raw", {"raw": "r"}) == "r.t"


def test_inventory(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    assert catalog.table_inventory(spark, name).count() == 0
    writes.append_raw(raw(frame, (1, "a", 1, 1), (2, "a", 1, 1)), f"{name}.full")
    raw(frame, (1, "a", 1, 1)).where("false").write.saveAsTable(f"{name}.empty")
    got = {r["table_name"]: r for r in catalog.table_inventory(spark, name).collect()}
    assert got["full"]["row_count"] == 2 and not got["full"]["is_empty"]
    assert got["empty"]["row_count"] == 0 and got["empty"]["is_empty"]
    assert got["full"]["created_at"] is not None


def test_inventory_has_the_sizes_of_the_file_system_newest_first(spark, frame, folder):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    for table, rows in (("b", 60_000), ("a", 90_000), ("c", 10)):
        made = spark.range(rows).select(F.date_add(F.lit(day(1)), (F.col("id") % 3).cast("int")).alias("date"), F.rand(1).alias("x"))
        made.write.partitionBy("date").saveAsTable(f"{name}.{table}")
        time.sleep(1.1)  # the catalog keeps whole seconds
    found = catalog.table_inventory(spark, name).collect()
    assert [r["table_name"] for r in found] == ["c", "a", "b"]
    assert [r["created_at"] for r in found] == sorted((r["created_at"] for r in found), reverse=True)
    for row in found:
        at = Path(urlparse(catalog.location_of(spark, f"{name}.{row['table_name']}")).path)
        assert row["size_mb"] == round(sum(f.stat().st_size for f in at.rglob("*.parquet")) / 1048576, 2)
    assert found[1]["size_mb"] > found[2]["size_mb"] > 0.1


def test_inventory_by_day(spark, frame, folder):
    target, ledger = folder("raw"), Ledger(spark, folder("ledger"))
    watch = Watch(ledger, {"raw": None})
    writes.append_raw(raw(frame, (1, "a", 1, 1), (1, "b", 1, 1), (2, "a", 1, 1)), target, watch=watch)
    writes.append_raw(raw(frame, (1, "c", 2, 1)), target, watch=watch)
    found = {r["day"]: r for r in catalog.inventory_by_day(spark, target, ledger, "raw").collect()}
    assert {d: r["row_count"] for d, r in found.items()} == {day(1): 3, day(2): 1}
    for d, row in found.items():
        files = list((Path(urlparse(target).path) / f"date={d}").glob("*.parquet"))
        assert (row["n_files"], row["bytes"]) == (len(files), sum(f.stat().st_size for f in files))


def test_fixed_shape_scan(spark, frame, target):
    writes.append_raw(raw(frame, (1, "a", 1, 1)), target)
    row = scan_as(spark, target, S.RAW_GOOGLE).first()
    assert row["cost_usd"] is None and row["clicks"] == 1 and row["date"] == day(1)


def run(**changes):
    return runlog.Run(**{"run_id": "r", "dag_id": "d", "run_date": "2024-01-30",
                         "execution_date": "2024-01-30T05:00:00Z", "status": "success", **changes})


def test_run_summary_defaults(spark):
    got = runlog.run_summary(spark, run(), end_time="2024-01-30T05:00:01.6Z")
    assert got.schema.names == S.RUN_SUMMARY.names
    row = got.first()
    assert row["duration_seconds"] == 1
    assert (row["google_ads_extracted_count"], row["google_ads_status"]) == (0, "unknown")
    assert (row["dbt_run_status"], row["dbt_test_status"], row["volume_check_status"]) == ("not_run",) * 3
    assert row["dbt_docs_generated"] is False and row["error_message"] is None


def test_run_summary_rolls_up_its_checks(spark, frame):
    tests = frame([("PASS",), ("FAIL",)], "status string")
    volumes = frame([("PASS",), ("WARN",)], "status string")
    row = runlog.run_summary(spark, run(), tests, volumes).first()
    assert (row["dbt_test_status"], row["dbt_test_passed"], row["dbt_test_failed"]) == ("failed", 1, 1)
    assert (row["volume_check_status"], row["volume_check_tables_checked"],
            row["volume_check_tables_warned"]) == ("PASS", 2, 1)


def test_recent_runs(spark, folder):
    log = folder("log")
    for n in range(12):
        writes.append_run(
            runlog.run_summary(spark, run(run_id=f"r{n}", execution_date=f"2024-01-{n + 1:02d}T05:00:00Z")), log)
    got = runlog.recent_runs(scan(spark, log))
    assert [r["run_id"] for r in got.collect()] == [f"r{n}" for n in range(11, 1, -1)]
    assert tuple(got.columns) == runlog.RECENT_RUN_COLUMNS
    assert runlog.recent_runs(scan(spark, log), 3).count() == 3


def test_daily_run_twice(spark, frame, folder):
    names = {layer: f"{n}_{uuid.uuid4().hex[:8]}" for layer, n in catalog.LAYERS.items()}
    catalog.create_namespaces(spark, names, folder("schemas"))
    layers = daily.Layers(names)
    g = frame([(dt.date(2024, 1, 29), f"g{i}", "G", 100, 10, 2, 5.0) for i in range(12)], S.GOOGLE_RECORD)
    m = frame([(dt.date(2024, 1, 29), f"m{i}", "M", 100, 10, None, 5.0, 1, 1, 1, None, None)
               for i in range(12)], S.META_RECORD)
    for n in (1, 2):
        log = daily.run_daily(spark, g, m, layers, "2024-01-30", run_id=f"r{n}",
                              ingested_at=f"2024-01-30T0{n}:00:00Z", started_at="2024-01-30T00:00:00Z",
                              ended_at="2024-01-30T00:01:00Z")
        row = log.first()
        assert row["run_id"] == f"r{n}" and row["dbt_test_passed"] == 36
        assert row["volume_check_status"] == "PASS" and row["volume_check_tables_checked"] == 5
    mart = spark.table(layers.mart)
    assert mart.count() == 24 and values(mart.select("extract_run_id").distinct()) == [("r2",)]
    assert spark.table(layers.run_summary).count() == 2


def test_a_run_over_recent_days_equals_a_full_one(spark, frame, folder):
    def records(clicks, *days):
        google = frame([(day(d), f"g{i}", "G", 100, clicks, 2, 5.0) for d in days for i in range(3)],
                       S.GOOGLE_RECORD)
        meta = frame([(day(d), f"m{i}", "M", 100, clicks, None, 5.0, 1, 1, 1, None, None)
                      for d in days for i in range(3)], S.META_RECORD)
        return google, meta

    marts = []
    for since in (None, "2024-01-08"):
        names = {layer: f"{n}_{uuid.uuid4().hex[:8]}" for layer, n in catalog.LAYERS.items()}
        catalog.create_namespaces(spark, names, folder("schemas"))
        layers = daily.Layers(names)
        fixed = {"started_at": "2024-01-10T00:00:00Z", "ended_at": "2024-01-10T00:01:00Z"}
        daily.run_daily(spark, *records(10, 1, 8, 9), layers, "2024-01-09", "r1", "2024-01-10T01:00:00Z", **fixed)
        daily.run_daily(spark, *records(20, 8, 9), layers, "2024-01-10", "r2", "2024-01-11T01:00:00Z",
                        since=since, **fixed)
        marts.append(values(spark.table(layers.mart).drop("mart_created_at")))
        assert spark.table(layers.raw_google).count() == 9
    assert marts[0] == marts[1] and len(marts[0]) == 18


def test_a_failed_run_is_logged_with_its_step(spark, frame, folder):
    names = {layer: f"{n}_{uuid.uuid4().hex[:8]}" for layer, n in catalog.LAYERS.items()}
    catalog.create_namespaces(spark, names, folder("schemas"))
    layers = daily.Layers(names)
    google = frame([(day(1), "g", "G", 100, 10, 2, 5.0)], S.GOOGLE_RECORD)
    meta = frame([(day(1), "m", "M", 100, 10, None, 5.0, 1, 1, 1, None, None)], S.META_RECORD)
    unreadable = meta.withColumn("clicks", F.raise_error(F.lit("bad payload")).cast("long"))
    with pytest.raises(Exception, match="bad payload"):
        daily.run_daily(spark, google, unreadable, layers, "2024-01-02", "r1", "2024-01-02T00:00:00Z")
    row = spark.table(layers.run_summary).first()
    assert (row["status"], row["error_task"]) == ("failed", "ingest_meta_ads")
    assert "bad payload" in row["error_message"]
    assert (row["google_ads_extracted_count"], row["meta_ads_status"]) == (1, "unknown")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_over_a_stored_mart_prune_days_and_columns(spark, frame, folder):
    target = folder("mart")
    union = frame(
        [(day(d), f"c{d}", "C", 100, 10, 2, 5.0, None, None, None, None, None,
          dt.datetime(2024, 1, 31), "a", S.GOOGLE, S.GOOGLE) for d in range(1, 11)], S.UNIFIED)
    writes.write_mart(mart.build_mart(union, "2024-02-01T00:00:00Z"), target)
    stored = scan_as(spark, target, S.MART)
    plan = plan_of(analysis.top_roas(stored, "2024-01-31"))
    assert "PartitionFilters: [isnotnull(report_date" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<campaign_name:string,platform:string,spend:double,conversions:bigint,roas:double>" in plan
    trend = plan_of(analysis.daily_trend(stored, "C", "2024-01-31"))
    assert "EqualTo(campaign_name,C)" in trend
    counted = plan_of(analysis.platform_comparison(stored, "2024-01-31"))
    assert "hashpartitioning(platform#" in counted and counted.count("FileScan") == 1


def test_the_late_window_reads_its_days_only(spark, frame, folder):
    target = folder("raw")
    writes.append_raw(raw(frame, *((d, "a", 1, 1) for d in range(1, 12))), target)
    plan = plan_of(restate(scan(spark, target), raw(frame, (9, "a", 2, 2)), "2024-01-10"))
    assert "PartitionFilters: [isnotnull(date" in plan


def test_the_mart_is_sorted_once_after_its_rebalance(spark, folder, mart_rows):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"marts": name}, folder("schemas"))
    writes.write_mart(mart_rows(30), f"{name}.t")
    prepared, _ = writes._prepared(mart_rows(30), writes.MART_LAYOUT, writes.MART_CLUSTER)
    prepared.select(*spark.table(f"{name}.t").columns).createOrReplaceTempView("prepared_mart")
    plan = spark.sql(f"explain insert into {name}.t select * from prepared_mart").first()[0]
    assert plan.count("Sort [") == 1 and plan.count("REBALANCE_PARTITIONS_BY_COL") == 1


@pytest.mark.parametrize("write", [writes.append_raw, writes.replace_partitions])
def test_batches_of_one_table_may_differ_in_columns(spark, frame, folder, write):
    name = f"s_{uuid.uuid4().hex[:8]}"
    catalog.create_namespaces(spark, {"raw": name}, folder("schemas"))
    table = f"{name}.t"
    flat = raw(frame, (1, "a", 1, 1)).withColumn("conversions", F.lit(4).cast("long"))
    nested = raw(frame, (2, "b", 2, 1)).withColumn("video_views", F.lit(7).cast("long"))
    write(flat, table)
    write(nested, table)
    assert values(spark.table(table), "campaign_id", "clicks", "conversions", "video_views", "date") == [
        ("a", 1, 4, None, day(1)), ("b", 2, None, 7, day(2)),
    ]
