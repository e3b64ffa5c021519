"""Listing landed files."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nephogrid.sources import listing


@pytest.fixture
def root(tmp_path):
    for key, size in {
        "2024/01/31/11/x_blend_s20240131113000.nc": 5, "2024/01/31/11/y_blend_.nc": 9, "2024/01/31/12/z_full_.nc": 99, "2024/01/31/12/z_blend_.tmp": 98,
        "2024/01/30/23/old_blend_.nc": 50, "2023/12/31/00/older_blend_.nc": 60, "2024/02/30/00/never_blend_.nc": 70, "2024/1/31/11/odd_blend_.nc": 80, "readme_blend_.nc": 1, "2024/01/31/11/deep/d_blend_.nc": 90,
    }.items():
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_bytes(bytes(size))
    return tmp_path


def hours(df):
    return sorted((r["key"], r["size"]) for r in df.collect())


def test_whole_listing_and_bounds(spark, root):
    df = listing.listed(spark, str(root), hours_per_partition=1)
    assert listing.listed(spark, str(root)).rdd.getNumPartitions() == 1 and hours(listing.listed(spark, str(root))) == hours(df)
    assert listing.listed(spark, str(root), datetime(2024, 1, 31), hours_per_partition=1).rdd.getNumPartitions() == 2
    assert [k for k, _ in hours(df)] == ["2023/12/31/00/older_blend_.nc", "2024/01/30/23/old_blend_.nc", "2024/01/31/11/x_blend_s20240131113000.nc", "2024/01/31/11/y_blend_.nc", "2024/01/31/12/z_blend_.tmp", "2024/01/31/12/z_full_.nc"]
    assert df.rdd.getNumPartitions() == 4
    at = lambda *x: F.lit(datetime(*x, tzinfo=UTC))
    some = df.where(F.col("hour").between(at(2024, 1, 30, 5), at(2024, 1, 31, 11)))
    assert some.rdd.getNumPartitions() == 2 and [s for _, s in hours(some)] == [50, 5, 9]
    assert df.where(F.col("hour") > at(2024, 1, 31, 11)).rdd.getNumPartitions() == 2  # Spark drops the hour itself
    assert hours(df.where(F.col("hour") < at(2024, 1, 1))) == [("2023/12/31/00/older_blend_.nc", 60)]
    assert hours(df.where(F.col("hour") == at(2025, 1, 1))) == [] == hours(listing.listed(spark, str(root / "absent")))
    first = df.where("size = 9").first()
    assert first["hour"] == datetime(2024, 1, 31, 11) and abs((first["modified"] - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 86400


def test_folders_outside_are_not_listed(root):
    class Store:
        def __init__(self, store):
            self.store, self.seen = store, []

        def get_file_info(self, selector):
            self.seen.append(selector.base_dir.removeprefix(str(root)))
            return self.store.get_file_info(selector)

    store, path = listing.file_system(str(root))
    store = Store(store)
    found = listing.hour_folders(store, path, datetime(2024, 1, 31, 10, tzinfo=UTC), datetime(2024, 1, 31, 12, tzinfo=UTC))
    assert [h.hour for _, h in found] == [12, 11] and store.seen == ["", "/2024", "/2024/01", "/2024/01/31"]


def test_newest_stops_early(spark, root, monkeypatch):
    asked = []
    windows = listing._windows
    monkeypatch.setattr(listing, "_windows", lambda *a: (asked.append(w) or w for w in windows(*a)))
    got = listing.newest(spark, str(root), datetime(2024, 1, 31, 15, 40), hours_at_once=2).first()
    assert (got["key"], got["size"]) == ("2024/01/31/11/y_blend_.nc", 9) and len(asked) == 1
    got = listing.newest(spark, str(root), datetime(2024, 1, 31, 2, 40), hours_at_once=2).first()
    assert got["key"] == "2024/01/30/23/old_blend_.nc" and len(asked) == 1 + 1
    with pytest.raises(LookupError):
        listing.newest(spark, str(root), datetime(2024, 3, 31, 2, 40), days_back=2)
    assert asked[-1][1] == datetime(2024, 3, 29, tzinfo=UTC) and all(a - b <= timedelta(hours=23) for a, b in asked)
