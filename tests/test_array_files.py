import glob
import json

import pytest

from checks import queries
from adloom import sources
from adloom.sources import adapters

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("platform", ["google", "meta"])
def test_a_large_day_has_several_files(spark, monkeypatch, platform):
    monkeypatch.setattr(queries, "ARRAY_RECORDS", 20, raising=False)
    raw, spend, source = {
        "google": (adapters.raw_google, "cost_usd", sources.GOOGLE_SAMPLE),
        "meta": (adapters.raw_meta, "spend_usd", sources.META_SAMPLE),
    }[platform]
    records = queries._by_account(raw(spark, FOLDER), spend)
    folder = queries._array_files(spark, records, "arrays")
    files = glob.glob(f"{folder.removeprefix('file:')}/date=*/*.txt")
    sizes = [len(json.loads(open(f).read())) for f in files]  # one array each
    assert sum(sizes) == records.count() and max(sizes) <= 50
    days = records.groupBy("date").count().collect()
    assert max(r["count"] for r in days) > 20 and len(files) > len(days)
    read = source.read(spark, folder, *queries.RANGE)
    assert read.count() == records.where(records.date.between(*queries.RANGE)).count()
