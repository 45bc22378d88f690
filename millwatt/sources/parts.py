"""Tables kept as parts, so that a change rewrites only the parts it touches.

A part (a day, a bucket of keys) is one folder that is never written twice. A manifest lists the folder of every part,
the settings the table was made with, and the batches that are in it; readers see the newest complete manifest, so a change of
any number of parts and the note that a batch was applied become visible together. One job writes a table at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.sources.files import delete_folder, empty, exists, folders, numbered_folders

ENTRIES = "kind string, name string, value string"


class Manifest:
    """Versions of a list of named values, grouped by kind; small, as it has a row for each part and stream."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def version(self) -> int:
        """Newest version that was written to its end, -1 before the first."""
        found = numbered_folders(self.spark, f"{self.folder}/version=*")
        return max((n for n, path in found.items() if exists(self.spark, f"{path}/_SUCCESS")), default=-1)

    def entries(self) -> dict[str, dict[str, str]]:
        """The newest version: for each kind its values by name."""
        number, found = self.version(), {}
        if number >= 0:
            for r in self.spark.read.schema(ENTRIES).parquet(f"{self.folder}/version={number}").collect():
                found.setdefault(r.kind, {})[r.name] = r.value
        return found

    def publish(self, entries: Mapping[str, Mapping[str, str]]) -> int:
        """Write the next version, which readers see from then on, and return its number."""
        number = self.version() + 1
        rows = [(kind, name, value) for kind, values in entries.items() for name, value in values.items()]
        frame = self.spark.createDataFrame(rows, ENTRIES).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.folder}/version={number}")
        return number

    def clean(self) -> None:
        """Remove all versions but the newest."""
        newest = self.version()
        for number, path in numbered_folders(self.spark, f"{self.folder}/version=*").items():
            if number < newest:
                delete_folder(self.spark, path)


class PartTable:
    """A table of ``schema`` under ``folder``; the part of a row is in the extra column :data:`PART` when it is written.

    The table's own columns must not have the names of the two folder columns.
    """

    PART = "table_part"
    VERSION = "table_version"

    def __init__(self, spark: SparkSession, folder: str, schema: str, settings: dict[str, str] | None = None):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.manifest = Manifest(spark, f"{self.folder}/manifest")
        self.settings = settings or {}
        known = self.notes("setting")
        if known and known != self.settings:
            raise ValueError(f"the table at {folder} was made with {known}, not {self.settings}")

    def notes(self, kind: str) -> dict[str, str]:
        return self.manifest.entries().get(kind, {})

    def parts(self) -> dict[str, str]:
        """Folder of every part."""
        return self.notes("part")

    def applied(self, stream: str, batch_id: int) -> bool:
        """Whether the batch is in the table; the batches of a stream come in order."""
        return int(self.notes("batch").get(stream, -1)) >= batch_id

    def read(self, names: Iterable[str] | None = None, with_part: bool = False, parts: Mapping[str, str] | None = None) -> DataFrame:
        """All rows, or those of some parts; only their folders are read. A filter on the part prunes, too.

        ``parts`` are those of a manifest read before, for readers that need other entries of the same version.
        """
        known = self.parts() if parts is None else parts
        paths = [known[n] for n in sorted(known if names is None else set(names) & set(known))]
        placed = f"{self.schema}, {self.PART} string, {self.VERSION} bigint"
        reader = self.spark.read.schema(placed).option("basePath", f"{self.folder}/data")
        rows = reader.parquet(*paths) if paths else empty(self.spark, placed)
        return rows.drop(self.VERSION) if with_part else rows.drop(self.VERSION, self.PART)

    def replace(
        self,
        df: DataFrame,
        names: Iterable[str],
        batch: tuple[str, int] | None = None,
        notes: Mapping[str, Mapping[str, str]] | None = None,
        laid_out: bool = False,
    ) -> dict[str, str]:
        """Write ``df``, the whole new content of the parts ``names``, and publish; parts without rows are gone.

        Parts not named keep their folders. ``notes`` replace those of their kind. Unless ``df`` is already laid out
        as its files should be, large parts become several files and small ones share a task. Returns the folders written.
        """
        entries = self.manifest.entries()
        number = self.manifest.version() + 1
        root = f"{self.folder}/data/{self.VERSION}={number}"
        spread = df.select(*empty(self.spark, self.schema).columns, self.PART)
        spread = spread if laid_out else spread.hint("rebalance", self.PART)
        spread.write.mode("overwrite").partitionBy(self.PART).option("compression", "zstd").parquet(root)
        made = {path.rstrip("/").rsplit("=", 1)[1]: path for path in folders(self.spark, f"{root}/{self.PART}=*")}
        names = set(names)
        if not set(made) <= names:
            raise ValueError(f"rows of parts that are not replaced: {sorted(set(made) - names)[:5]}")
        parts = {n: p for n, p in entries.get("part", {}).items() if n not in names} | made
        batches = entries.get("batch", {}) | ({batch[0]: str(batch[1])} if batch else {})
        self.manifest.publish(entries | {"part": parts, "batch": batches, "setting": self.settings} | dict(notes or {}))
        return made

    def drop(self, names: Iterable[str], notes: Mapping[str, Mapping[str, str]] | None = None) -> None:
        """Publish the table without some parts."""
        gone, entries = set(names), self.manifest.entries()
        parts = {n: p for n, p in entries.get("part", {}).items() if n not in gone}
        self.manifest.publish(entries | {"part": parts} | dict(notes or {}))

    def clean(self) -> list[str]:
        """Remove folders that the newest version does not use; run it when no reader is on older ones."""
        used = {p.rstrip("/") for p in self.parts().values()}
        gone = [p for p in folders(self.spark, f"{self.folder}/data/{self.VERSION}=*/{self.PART}=*") if p.rstrip("/") not in used]
        for path in gone:
            delete_folder(self.spark, path)
        self.manifest.clean()
        return sorted(gone)
