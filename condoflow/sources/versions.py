"""Table sets on plain parquet, published as a whole and rewritten by partition.

A run writes only what is new or changed, into a folder of its own, and a manifest that lists for every table and partition
the folders that make it up, with their row counts: folders of earlier runs where a partition is as it was, both where rows
were added, its own where the partition was replaced.  The run counts once its number stands among the pointers, a file that can be
created only once; readers follow the highest one, so they see all tables of a run or none, and of two runs that
start from the same version the second one fails.  Folders are never changed after that.

Facts are partitioned by month, see ``schemas.PARTITION_BY``; rows without one are in the partition ``OPEN``.  A table without
a month is one partition ``WHOLE``.  Partitions and counts come from the manifest, so choosing months or counting a table reads no data.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas

OPEN, WHOLE = "abierto", "todo"
MANY = 24  # folders of a partition from which compaction pays
_MANIFEST = "tabla string, particion string, ruta string, filas bigint"


def month_name(period: dt.date) -> str:
    """Partition of the rows of a month."""
    return f"{period:%Y-%m}"


def _partition(table: str) -> Column:
    by = schemas.PARTITION_BY.get(table)
    return F.lit(WHOLE) if by is None else F.coalesce(F.date_format(by, "yyyy-MM"), F.lit(OPEN))


@dataclass(frozen=True)
class Folder:
    """Rows of one partition that one run wrote; ``path`` is relative to the root of the tables."""

    partition: str
    path: str
    rows: int


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _pointers(spark: SparkSession, root: str) -> dict[int, str]:
    """Sequence number and path of every published run; none where the folder is missing, any other failure is raised."""
    fs, path = _file_system(spark, f"{root}/pointers")
    if not fs.exists(path):
        return {}
    names = [(s.getPath().getName(), s) for s in fs.listStatus(path)]
    return {int(n): s.getPath().toString() for n, s in names if n.isdigit() and s.getLen() > 0}  # an empty one is being written


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest published run, None before the first."""
    return Snapshot.open(spark, root).version


class Snapshot:
    """The tables as one run left them."""

    def __init__(self, spark: SparkSession, root: str, version: str | None, sequence: int, folders: dict[str, list[Folder]]):
        self.spark, self.root, self.version, self.sequence, self.folders = spark, root, version, sequence, folders

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Snapshot:
        published = _pointers(spark, root)
        if not published:
            return cls(spark, root, None, 0, {})
        sequence = max(published)
        version = spark.read.text(published[sequence]).first()[0].strip()
        folders: dict[str, list[Folder]] = {}
        for r in spark.read.schema(_MANIFEST).parquet(f"{root}/{version}/manifest").collect():
            folders.setdefault(r.tabla, []).append(Folder(r.particion, r.ruta, r.filas))
        return cls(spark, root, version, sequence, folders)

    def partitions(self, table: str) -> set[str]:
        return {f.partition for f in self.folders.get(table, ())}

    def rows(self, table: str) -> int:
        return sum(f.rows for f in self.folders.get(table, ()))

    def audit(self) -> DataFrame:
        """(tabla, registros) of every declared table, from the manifest."""
        return self.spark.createDataFrame([(t, self.rows(t)) for t in schemas.TABLES], "tabla string, registros bigint")

    def read(self, table: str, partitions: Iterable[str] | None = None) -> DataFrame:
        """A table, or its given partitions only; no other folder is looked at."""
        wanted = None if partitions is None else set(partitions)
        return self._frame(table, [f for f in self.folders.get(table, ()) if wanted is None or f.partition in wanted])

    def _frame(self, table: str, folders: list[Folder]) -> DataFrame:
        schema = schemas.TABLES[table]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{f.path}" for f in folders))


class NewVersion(Snapshot):
    """A run being written on top of the newest published one; it reads its own writes."""

    def __init__(self, spark: SparkSession, root: str):
        self.base = base = Snapshot.open(spark, root)
        super().__init__(spark, root, f"version-{uuid.uuid4().hex}", base.sequence + 1, {t: list(f) for t, f in base.folders.items()})
        self.written: dict[str, list[Folder]] = {}

    def write(self, table: str, df: DataFrame, replacing: Iterable[str] | None = ()) -> DataFrame:
        """Add rows to a table in its declared layout; the partitions ``replacing`` (None: all) lose what they held before.

        Returns the rows written, to be read back by later steps instead of computed again.
        """
        path = f"{self.version}/{table}-{len(self.written.get(table, ())):03d}"
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[table]])
        rows.withColumn("particion", _partition(table)).write.partitionBy("particion").parquet(f"{self.root}/{path}")
        counts = self.spark.read.schema("particion string").parquet(f"{self.root}/{path}").groupBy("particion").count().collect()
        new = [Folder(r["particion"], f"{path}/particion={r['particion']}", r["count"]) for r in counts]
        gone = self.partitions(table) if replacing is None else set(replacing)
        self.folders[table] = [f for f in self.folders.get(table, ()) if f.partition not in gone] + new
        self.written.setdefault(table, []).extend(new)
        return self._frame(table, new)

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Write a table whose rows may change anywhere, which is none of the facts."""
        return self.write(table, df, replacing=None)

    def stage(self, df: DataFrame) -> DataFrame:
        """A frame that several steps use, written once; its folder goes when the run is published."""
        path = f"{self.root}/{self.version}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> str:
        """Publish the run; fails, and changes nothing, if another one was published since this one began."""
        entries = [(t, f.partition, f.path, f.rows) for t, folders in self.folders.items() for f in folders]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.parquet(f"{self.root}/{self.version}/manifest")
        fs, path = _file_system(self.spark, f"{self.root}/pointers/{self.sequence:08d}")
        if fs.exists(path):
            raise RuntimeError("another run was published meanwhile")
        out = fs.create(path, False)  # not over an existing file
        out.write(bytearray(self.version.encode()))
        out.close()
        fs, steps = _file_system(self.spark, f"{self.root}/{self.version}/steps")
        fs.delete(steps, True)
        return self.version


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current version, empty before the first run."""
    return Snapshot.open(spark, root).read(table)


def compact(spark: SparkSession, root: str, many: int = MANY) -> list[tuple[str, str]]:
    """Publish a version in which partitions of ``many`` folders or more are one; returns these (table, partition)."""
    out, done = NewVersion(spark, root), []
    for table in list(out.folders):
        parts = [p for p in out.partitions(table) if sum(f.partition == p for f in out.folders[table]) >= many]
        if parts:
            out.write(table, out.read(table, parts), replacing=parts)
            done += [(table, p) for p in parts]
    if done:
        out.commit()
    return sorted(done)
