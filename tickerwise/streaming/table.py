"""ST4: a keyed table that a stream keeps up to date, and that stays small to read.

Every micro-batch writes its rows to a folder of its epoch.  ``fanout`` folders of a level are merged into one of the next level
(newest row per key), so after n epochs a read meets at most ``fanout`` folders a level and log(n) levels.  What belongs to
the table is said by a manifest, one small file per epoch, renamed into place: a reader takes the newest manifest and finds
exactly the folders it names.  A retry of an epoch writes the same folders and the same manifest again; a crash between any two
steps leaves the old manifest valid.  Folders leave the disk two epochs after they left the manifest.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Part:
    """A folder: its level and the epochs whose rows it holds."""

    name: str
    level: int
    first: int
    last: int


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], rank: Column | None = None, fanout: int = 8):
        """``rank``: of rows with equal keys the highest rank wins (then the larger row); without it the row of the latest epoch."""
        if fanout < 2:
            raise ValueError("fanout is 2 at least")
        self.spark, self.path, self.schema, self.keys, self.rank, self.fanout = spark, path.rstrip("/"), schema, keys, rank, fanout
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------- manifests
    def _manifests(self) -> list[int]:
        folder = self._path(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit())

    def _load(self, epoch: int) -> list[Part]:
        lines = self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{epoch}").first()[0]
        return [Part(**x) for x in json.loads(lines)]

    def _publish_manifest(self, epoch: int, parts: list[Part]) -> None:
        final, draft = self._path(f"{self.path}/manifest/{epoch}"), self._path(f"{self.path}/manifest/_{epoch}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps([asdict(p) for p in parts]).encode()))
        out.close()
        self._fs.delete(final, False)  # of an earlier try of this epoch; the one before it stays valid meanwhile
        if not self._fs.rename(draft, final):
            raise OSError(f"cannot publish {final}")

    def parts(self, before: int | None = None) -> list[Part]:
        """The folders of the newest manifest (of those before an epoch)."""
        numbers = [n for n in self._manifests() if before is None or n < before]
        return self._load(numbers[-1]) if numbers else []

    # ----------------------------------------------------------------- rows
    def _merged(self, parts: list[Part]) -> DataFrame:
        rows = None
        for p in parts:
            one = self.spark.read.schema(self.schema).parquet(f"{self.path}/{p.name}").withColumn("_epoch", F.lit(p.last))
            rows = one if rows is None else rows.unionByName(one)
        if rows is None:
            rows = self.spark.createDataFrame([], self.schema).withColumn("_epoch", F.lit(0))
        fields = [c for c in self.schema.names if c not in self.keys]
        if self.rank is None:
            best = F.max_by(F.struct(*fields), "_epoch")
        else:
            best = F.max(F.struct(self.rank.alias("_rank"), *fields))
        return rows.groupBy(*self.keys).agg(best.alias("_r")).select(*self.keys, *[F.col("_r")[c].alias(c) for c in fields]).select(self.schema.names)

    def read(self) -> DataFrame:
        """The table as of the newest manifest."""
        return self._merged(self.parts())

    def publish(self, batch: DataFrame, epoch: int) -> None:
        """Add the rows of a micro-batch; safe to repeat for the same epoch."""
        old = self.parts(before=epoch)
        batch.select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/epoch-{epoch}")
        parts = [*old, Part(f"epoch-{epoch}", 0, epoch, epoch)]
        level = 0
        while len(full := [p for p in parts if p.level == level]) >= self.fanout:
            merged = Part(f"level-{level + 1}-to-{full[-1].last}", level + 1, full[0].first, full[-1].last)
            self._merged(full).write.mode("overwrite").parquet(f"{self.path}/{merged.name}")
            parts = sorted([p for p in parts if p.level != level] + [merged], key=lambda p: p.first)
            level += 1
        self._publish_manifest(epoch, parts)
        self._clean(epoch)

    def _clean(self, epoch: int) -> None:
        """Drop manifests older than the last three, and folders that none of those names."""
        numbers = [n for n in self._manifests() if n <= epoch]
        keep = {p.name for n in numbers[-3:] for p in self._load(n)}
        for n in numbers[:-3]:
            self._fs.delete(self._path(f"{self.path}/manifest/{n}"), False)
        for s in self._fs.listStatus(self._path(self.path)):
            name = s.getPath().getName()
            if name != "manifest" and name not in keep:
                self._fs.delete(s.getPath(), True)
