import datetime as dt
import json

import pytest
from adloom import schemas as S
from adloom.operators.latest import latest_raw
from adloom.sources.tables import is_path, scan
from adloom.streaming import newest
from conftest import values
from pyspark.sql import functions as F

NAMES = S.RAW_META.names


def record(day, campaign, at, clicks, run="r"):
    return {"date": day and f"2024-01-{day:02d}", "campaign_id": campaign, "clicks": clicks,
            "ingested_at": at and f"2024-02-{at:02d}T00:00:00Z", "extract_run_id": run, "impressions": 9_007_199_254_740_993}


@pytest.fixture()
def stream(spark, tmp_path, folder):
    landing, target, checkpoint = tmp_path / "landing", folder("changes"), folder("checkpoint")
    landing.mkdir()
    assert is_path(target)

    def take(name=None, *records):
        if name:
            (landing / f"{name}.json").write_text("\n".join(map(json.dumps, records)))
        rows = spark.readStream.schema(S.RAW_META).option("maxFilesPerTrigger", 1).json(str(landing))
        newest.ingest_newest(rows, target, checkpoint)
        return target

    take.landing, take.target, take.checkpoint = landing, target, checkpoint
    return take


def landed(spark, take):
    return spark.read.schema(S.RAW_META).json(str(take.landing))


def test_the_newest_of_each_key(spark, stream):
    stream("a", record(1, "x", 1, 1), record(1, "x", 2, 2), record(1, "y", 1, 1), record(None, None, 1, 5), record(2, "x", None, 4))
    stream("b", record(1, "x", 3, 3), record(1, "y", 1, 9, "a"), record(1, "z", 1, 1), record(None, None, 2, 6))
    target = stream("c", record(1, "x", 2, 8), record(3, "x", 1, 1))
    got = newest.newest_rows(spark, target, S.RAW_META)
    assert values(got, *NAMES) == values(latest_raw(landed(spark, stream)), *NAMES)
    # One row for each key of a batch.
    assert scan(spark, target).count() == 4 + 4 + 2
    assert {r[0] for r in values(got, "impressions")} == {9_007_199_254_740_993}


def test_bytes_follow_the_rows_and_not_the_batches(spark, stream):
    """Eight batches over one day: each writes its own rows once."""
    for n in range(8):
        target = stream(f"f{n:02d}", *(record(1, f"c{n}-{i}", 1, i) for i in range(200)))
    files = scan(spark, target).select("_metadata.file_path", "_metadata.file_size", newest.BATCH).distinct()
    sizes = [r[0] for r in files.groupBy(newest.BATCH).agg(F.sum("file_size")).select("sum(file_size)").collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)
    assert scan(spark, target).count() == newest.newest_rows(spark, target, S.RAW_META).count() == 1600


def test_a_repeated_batch_replaces_its_files(spark, stream, folder):
    target = stream("a", record(1, "x", 1, 1), record(1, "y", 1, 1))
    rows = spark.readStream.schema(S.RAW_META).json(str(stream.landing))
    newest.ingest_newest(rows, target, folder("other-checkpoint"))  # batch 0 again, as after a failure
    assert scan(spark, target).count() == 2


def test_compaction_keeps_the_newest_rows(spark, stream):
    stream("a", record(1, "x", 1, 1), record(2, "x", 1, 1), record(None, "n", 1, 1))
    target = stream("b", record(1, "x", 2, 2), record(1, "y", 2, 2), record(None, "n", 2, 2))
    before = values(newest.newest_rows(spark, target, S.RAW_META), *NAMES)
    assert newest.compact_changes(spark, target, S.RAW_META) == 2
    assert values(newest.newest_rows(spark, target, S.RAW_META), *NAMES) == before
    assert scan(spark, target).count() == 4
    assert newest.compact_changes(spark, target, S.RAW_META) == 0
    # The stream goes on.
    target = stream("c", record(1, "x", 3, 3), record(1, "y", 1, 0))
    assert {tuple(r) for r in newest.newest_rows(spark, target, S.RAW_META).where("date = date'2024-01-01'").select("campaign_id", "clicks").collect()} == {("x", 3), ("y", 2)}
    assert dt.date(2024, 1, 1) in {r.date for r in scan(spark, target).collect()}


def test_a_compaction_that_stops_before_it_deletes_loses_nothing(spark, stream, monkeypatch):
    stream("a", record(1, "x", 1, 1))
    target = stream("b", record(1, "x", 2, 2), record(1, "y", 2, 2))
    before = values(newest.newest_rows(spark, target, S.RAW_META), *NAMES)
    monkeypatch.setattr(newest, "_delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        newest.compact_changes(spark, target, S.RAW_META)
    monkeypatch.undo()
    assert values(newest.newest_rows(spark, target, S.RAW_META), *NAMES) == before
    assert newest.compact_changes(spark, target, S.RAW_META) == 1
    assert values(newest.newest_rows(spark, target, S.RAW_META), *NAMES) == before
