import json

import pytest

from adloom import schemas as S
from adloom import sources
from adloom.operators.latest import latest_raw
from adloom.operators.metadata import stamp
from adloom.sources.tables import scan_as
from adloom.streaming import ingest
from conftest import values

AT = "2024-02-01T00:00:00Z"


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, *records):
        (folder / f"{name}.json").write_text("\n".join(map(json.dumps, records)))
        return str(folder)

    return land


def insight(day, campaign, clicks):
    return {"date_start": day, "campaign_id": campaign, "campaign_name": "M", "clicks": str(clicks),
            "actions": [{"action_type": "comment", "value": str(clicks)}]}


def clock(batch):
    return f"2024-02-01T{batch:02d}:00:00Z"


def run(spark, path, target, checkpoint, **options):
    ingest.ingest_landed(
        spark, sources.META_NESTED, path, target, checkpoint, "meta", ingested_at=clock, **options
    )


def test_stream_equals_batch(spark, landing, folder):
    target, checkpoint = folder("raw"), folder("checkpoint")
    path = landing("one", insight("2024-01-01", "1", 3), insight("2024-01-02", "1", 4))
    run(spark, path, target, checkpoint)
    landing("two", insight("2024-01-03", "2", 5))
    run(spark, path, target, checkpoint)
    run(spark, path, target, checkpoint)
    batch = stamp(sources.META_NESTED.read(spark, path, "2024-01-01", "2024-01-31"), S.META, "b", AT)
    streamed = scan_as(spark, target, S.RAW_META)
    columns = [c for c in batch.columns if c not in ("ingested_at", "extract_run_id")]
    assert values(streamed, *columns) == values(batch, *columns)
    assert values(streamed.select("extract_run_id").distinct()) == [
        ("meta-0000000000",), ("meta-0000000001",),
    ]


def test_newest_version_wins_after_the_stream(spark, landing, folder):
    target, checkpoint = folder("raw"), folder("checkpoint")
    path = landing("one", insight("2024-01-01", "1", 3))
    run(spark, path, target, checkpoint)
    landing("two", insight("2024-01-01", "1", 8))
    run(spark, path, target, checkpoint)
    raw = scan_as(spark, target, S.RAW_META)
    assert raw.count() == 2
    assert values(latest_raw(raw), "clicks", "comments") == [(8, 8)]


def test_a_repeated_batch_leaves_no_duplicates(spark, landing, folder):
    """A lost checkpoint makes the stream take the same files as batch 0 again."""
    target = folder("raw")
    path = landing("one", insight("2024-01-01", "1", 3), insight("2024-01-01", "2", 4))
    for _ in range(2):
        run(spark, path, target, folder("checkpoint"))
        assert scan_as(spark, target, S.RAW_META).count() == 2


def test_batches_are_bounded(spark, landing, folder):
    target = folder("raw")
    for n in range(3):
        path = landing(f"f{n}", insight("2024-01-01", str(n), 1))
    run(spark, path, target, folder("checkpoint"), files_per_batch=1)
    runs = scan_as(spark, target, S.RAW_META).select("extract_run_id").distinct().count()
    assert runs == 3
