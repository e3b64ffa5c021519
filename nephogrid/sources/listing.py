"""Listing of landed files as a Spark source: names, sizes and times, no contents.

Files lie below ``root/YYYY/MM/DD/HH/``. Bounds on ``hour`` that Spark pushes down choose the folders: years, months and days outside them are not even listed,
and what is left is listed in tasks, a day's hours in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from nephogrid.operators import discovery
from nephogrid.storage import file_system, pushed

SCHEMA = "key string, size long, modified timestamp, hour timestamp"
HOUR = timedelta(hours=1)


@dataclass
class HourPart(InputPartition):
    folders: list[tuple[str, datetime]]


def _utc(t: datetime) -> datetime:
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)


def hour_folders(store, root: str, low: datetime | None, high: datetime | None) -> list[tuple[str, datetime]]:
    """The folders of the hours from ``low`` to ``high`` (both included), newest first; folders that are no time are passed over."""
    from pyarrow import fs

    found: list[tuple[str, datetime]] = []

    def below(folder: str, parts: list[int]) -> None:
        selector = fs.FileSelector(folder, allow_not_found=True)
        for name in sorted((i.base_name for i in store.get_file_info(selector) if i.type == fs.FileType.Directory), reverse=True):
            if not (name.isascii() and name.isdigit() and len(name) == (2 if parts else 4)):
                continue
            own = [*parts, int(name)]
            try:
                first = datetime(*(own + [1, 1, 0][len(own) - 1 :])[:4], tzinfo=UTC)
            except ValueError:
                continue
            last = {1: datetime(min(9998, first.year) + 1, 1, 1, tzinfo=UTC), 2: (first + timedelta(days=32)).replace(day=1), 3: first + 24 * HOUR, 4: first + HOUR}[len(own)] - HOUR
            if (high is not None and first > high) or (low is not None and last < low):
                continue
            if len(own) == 4:
                found.append((f"{folder}/{name}", first))
            else:
                below(f"{folder}/{name}", own)

    below(root, [])
    return found


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.at_once = options["path"].rstrip("/"), int(options.get("hoursPerPartition", "24"))
        self.low, self.high = (_utc(datetime.fromisoformat(options[k])) if k in options else None for k in ("from", "to"))

    def partitions(self):
        store, root = file_system(self.root)
        found = hour_folders(store, root, self.low, self.high)
        return [HourPart(found[i : i + self.at_once]) for i in range(0, len(found), self.at_once)] or [HourPart([])]

    def read(self, partition):
        from pyarrow import fs

        store, root = file_system(self.root)
        for folder, hour in partition.folders:
            for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if i.type == fs.FileType.File:
                    yield i.path.removeprefix(root).lstrip("/"), i.size, i.mtime, hour


class PushedListingReader(ListingReader):
    def pushFilters(self, filters):
        """Bounds of ``hour`` choose folders; Spark applies them again, and all other filters."""
        for f in filters:
            if (getattr(f, "attribute", None) or [None])[0] == "hour" and isinstance(getattr(f, "value", None), datetime):
                kind, value = type(f).__name__, _utc(f.value)
                if kind in ("GreaterThan", "GreaterThanOrEqual", "EqualTo"):
                    self.low = value if self.low is None else max(self.low, value)
                if kind in ("LessThan", "LessThanOrEqual", "EqualTo"):
                    self.high = value if self.high is None else min(self.high, value)
            yield f


class Listing(DataSource):
    """``spark.read.format("hour_listing").load(root)``: (key, size, modified, hour), keys below the root. Register with ``spark.dataSource.register``."""

    @classmethod
    def name(cls):
        return "hour_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return (PushedListingReader if self.options.get("pushed", "true") == "true" else ListingReader)(self.options)


def listed(spark: SparkSession, root: str, low: datetime | None = None, high: datetime | None = None, hours_per_partition: int = 24) -> DataFrame:
    """(key, size, modified, hour) of the files below ``root/YYYY/MM/DD/HH/``, of the hours from ``low`` to ``high`` if given; filters on ``hour`` do the
    same where the session pushes filters to Python sources. Roots and hours that are not there have none."""
    spark.dataSource.register(Listing)
    out = spark.read.format("hour_listing").option("pushed", pushed(spark)).option("hoursPerPartition", str(hours_per_partition))
    for k, t in (("from", low), ("to", high)):
        out = out if t is None else out.option(k, _utc(t).isoformat())
    return out.load(root)


def newest(spark: SparkSession, root: str, now: datetime, days_back: int = 14, lag_hours: int = 3, suffix: str = ".nc", part: str = "_blend_", hours_at_once: int = 24) -> DataFrame:
    """``discovery.latest_largest`` of a landed product: the listing is read newest hours first, ``hours_at_once`` of them, and no further than the
    first that have a matching file. Raises if ``days_back`` days have none."""
    now = _utc(now)
    top = max(now.replace(hour=0, minute=0, second=0, microsecond=0), now.replace(minute=0, second=0, microsecond=0) - lag_hours * HOUR)
    low = now.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=days_back)
    for high, first in _windows(top, low, hours_at_once):
        some = listed(spark, root, first, high)
        found = discovery.latest_largest(some, F.lit(now), days_back, lag_hours, suffix, part).collect()
        if found:
            return spark.createDataFrame(found, "stamp timestamp, key string, size long")
    raise LookupError(f"no file below {root} in {days_back} days")


def _windows(top: datetime, low: datetime, hours: int) -> Iterator[tuple[datetime, datetime]]:
    while top >= low:
        yield top, max(low, top - (hours - 1) * HOUR)
        top -= hours * HOUR
