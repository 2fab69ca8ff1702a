"""Tables in one folder whose rows lie in parts by a hash of their key, changed together and part by part.

A change appends rows to parts, or replaces whole parts; parts that it does not touch keep their files.  Each change writes folders of its own and then a manifest that says which folders each part of each
table consists of: the newest finished manifest is what counts, so a change of several tables is there whole or not at all, a plan may read parts that its own result replaces, and a failed change leaves nothing that
is read.  ``vacuum`` removes what the newest manifest does not name.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .durable import remove

MANIFEST = "name string, part int, folders array<string>"


@dataclass
class Change:
    """Rows for a table; with ``replaced`` they are all that these parts then hold."""

    rows: DataFrame
    replaced: list[int] | None = None


class Parted:
    """``tables`` gives for each table its key column and schema."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, tuple[str, str]], *, parts: int = 64) -> None:
        self.spark, self.path, self.tables, self.parts = spark, path.rstrip("/"), tables, parts
        self.jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self.jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not self._list(f"{self.path}/about"):
            spark.createDataFrame([(parts,)], "parts int").coalesce(1).write.parquet(f"{self.path}/about")
        self.parts = spark.read.parquet(f"{self.path}/about").first()["parts"]
        self.load()

    def _list(self, folder: str) -> list[str]:
        at = self.jvm.Path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def load(self) -> None:
        found = [int(n[2:]) for n in self._list(f"{self.path}/manifest") if "_SUCCESS" in self._list(f"{self.path}/manifest/{n}")]
        self.version = max(found, default=0)
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={self.version}").collect() if found else []  # a row a table and part
        self.folders = {(r["name"], r["part"]): list(r["folders"]) for r in rows}

    def part(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """The parts of these keys (one column): at most as many as there are."""
        return sorted(r["part"] for r in keys.select(self.part(keys.columns[0]).alias("part")).distinct().collect())

    def read(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """The table, or these parts of it; files of other parts are not opened."""
        schema = self.tables[name][1]
        paths = [f"{self.path}/{name}/{folder}/part={p}" for (n, p), own in sorted(self.folders.items()) if n == name and (parts is None or p in parts) for folder in own]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, changes: dict[str, Change]) -> None:
        """All changes, or none."""
        folders = {k: list(v) for k, v in self.folders.items()}
        for name, change in changes.items():
            key, schema = self.tables[name]
            batch = uuid.uuid4().hex
            at = f"{self.path}/{name}/{batch}"
            columns = self.spark.createDataFrame([], schema).columns
            # one file a part, more where a part is large
            change.rows.select(*columns, self.part(key).alias("part")).hint("rebalance", "part").write.partitionBy("part").parquet(at)
            written = [int(n[5:]) for n in self._list(at) if n.startswith("part=")]
            if change.replaced is not None:
                if set(written) - set(change.replaced):
                    raise ValueError(f"rows of {name} outside the parts that are replaced")
                folders |= {(name, p): [] for p in change.replaced}
            for p in written:
                folders[name, p] = [*folders.get((name, p), ()), batch]
        rows = [(n, p, own) for (n, p), own in sorted(folders.items()) if own]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifest/v={self.version + 1}")
        self.folders, self.version = {k: v for k, v in folders.items() if v}, self.version + 1

    def vacuum(self) -> None:
        live = {(n, f) for (n, _), own in self.folders.items() for f in own}
        for name in self.tables:
            for folder in self._list(f"{self.path}/{name}"):
                if (name, folder) not in live:
                    remove(self.spark, f"{self.path}/{name}/{folder}")
                    continue
                for p in self._list(f"{self.path}/{name}/{folder}"):
                    if p.startswith("part=") and folder not in self.folders.get((name, int(p[5:])), ()):
                        remove(self.spark, f"{self.path}/{name}/{folder}/{p}")
        for v in self._list(f"{self.path}/manifest"):
            if v != f"v={self.version}":
                remove(self.spark, f"{self.path}/manifest/{v}")
