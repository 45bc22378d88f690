"""The raw telemetry table while streams land into it: compaction in place and retention beside the landing.

Streams go on writing ``stream=/batch_id=/date=`` folders under the root. Compaction merges the landed folders of settled
days into a :class:`PartTable` by day under ``_settled``, sorted by device, and marks them as covered in the same manifest that
publishes the day; readers take the settled days and the landed folders that are complete and not covered, so every reading
is there once at any time. Covered folders are removed later. A late reading for a settled day lands like any other, is read from there, and is
merged by the next compaction, which rewrites just that day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.sources.files import delete_folder, empty, folders
from millwatt.sources.parts import PartTable

SETTLED = "_settled"
COLUMNS = ["time", "value", "dimensions", "metadata", "device_id", "source", "date"]
_STORED = [name for name in COLUMNS if name != "date"]


def _place(folder: str) -> str:
    """``stream=s/batch_id=n/date=d`` of a landed folder."""
    return "/".join(folder.rstrip("/").split("/")[-3:])


def _day(place: str) -> str:
    return place.rsplit("=", 1)[1]


def _batch(place: str) -> tuple[str, int]:
    stream, batch, _ = (part.split("=", 1)[1] for part in place.split("/"))
    return stream, int(batch)


class RawTable:
    """Raw readings under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        fields = empty(spark, schemas.RAW_TELEMETRY).schema
        stored = ", ".join(f"{name} {fields[name].dataType.simpleString()}" for name in _STORED)
        self.settled = PartTable(spark, f"{self.root}/{SETTLED}", stored)

    def landed(self) -> dict[str, str]:
        """Landed folders of batches that were written to their end, by place; names only."""
        done = {p.rsplit("/", 1)[0].rstrip("/") for p in folders(self.spark, f"{self.root}/stream=*/batch_id=*/_SUCCESS")}
        found = folders(self.spark, f"{self.root}/stream=*/batch_id=*/date=*")
        return {_place(p): p for p in found if p.rstrip("/").rsplit("/", 1)[0] in done}

    def _seen(self) -> tuple[dict[str, dict[str, str]], dict[str, str]]:
        """One version of the manifest, and the landed folders that it does not cover.

        The manifest is read first: what is covered after that is still in its folder.
        """
        entries = self.settled.manifest.entries()
        covered = entries.get("covered", {})
        return entries, {place: path for place, path in self.landed().items() if place not in covered}

    def day_totals(self) -> dict[str, int]:
        """For each day how many landed folders ever came into it; it changes when, and only when, readings arrive."""
        entries, live = self._seen()
        totals = {day: int(n) for day, n in entries.get("merged", {}).items()}
        for place in live:
            totals[_day(place)] = totals.get(_day(place), 0) + 1
        return totals

    def read(self, days: Iterable[str] | None = None) -> DataFrame:
        """All readings, or those of some days; other days' folders are not touched."""
        return self._rows(days, *self._seen())

    def _rows(self, days: Iterable[str] | None, entries: dict[str, dict[str, str]], live: dict[str, str]) -> DataFrame:
        wanted = None if days is None else set(days)
        settled = self.settled.read(wanted, True, entries.get("part", {})).withColumn("date", F.col(PartTable.PART).cast("date"))
        paths = [path for place, path in sorted(live.items()) if wanted is None or _day(place) in wanted]
        rows = settled.select(*COLUMNS)
        if paths:
            landed = self.spark.read.schema(schemas.RAW_TELEMETRY).option("basePath", self.root).parquet(*paths)
            rows = rows.unionByName(landed.select(*COLUMNS))
        return rows

    def compact(self, before: str) -> list[str]:
        """Merge what has landed into days before ``before``; returns the days that were written."""
        from millwatt.sources.telemetry import by_device

        entries, live = self._seen()
        places = {place: path for place, path in live.items() if _day(place) < before}
        days = sorted({_day(place) for place in places})
        if days:
            merged = entries.get("merged", {})
            for place in places:
                merged[_day(place)] = str(int(merged.get(_day(place), 0)) + 1)
            covered = entries.get("covered", {}) | dict.fromkeys(places, "")
            # Just the folders that are marked: others may land meanwhile.
            rows = by_device(self._rows(days, entries, places)).withColumn(PartTable.PART, F.col("date").cast("string"))
            self.settled.replace(rows, days, notes={"covered": covered, "merged": merged}, laid_out=True)
        return days

    def clean(self) -> list[str]:
        """Remove covered folders and unused versions; run it when no reader is on older versions.

        Only the newest batch of a stream can be run again, and then brings back its folders: their marks stay.
        """
        covered = self.settled.notes("covered")
        gone = [path for place, path in self.landed().items() if place in covered]
        for path in gone:
            delete_folder(self.spark, path)
        newest: dict[str, int] = {}
        for place in [*covered, *self.landed()]:
            stream, number = _batch(place)
            newest[stream] = max(newest.get(stream, -1), number)
        kept = {place: "" for place in covered if _batch(place)[1] == newest[_batch(place)[0]]}
        if covered:
            self.settled.drop([], {"covered": kept})
        self.settled.clean()
        return sorted(_place(p) for p in gone)

    def retire(self, before: str) -> list[str]:
        """Give up the days before ``before``; returns them."""
        old = {place: path for place, path in self.landed().items() if _day(place) < before}
        settled = [day for day in self.settled.parts() if day < before]
        if settled:
            merged = {day: n for day, n in self.settled.notes("merged").items() if day >= before}
            self.settled.drop(settled, {"merged": merged})
        for path in old.values():
            delete_folder(self.spark, path)
        return sorted({*settled, *map(_day, old)})
