"""Versioned Parquet tables under one folder.

Data files are never changed. A version is one small JSON file that names, for
each table, the live data folders; publishing it moves every table at once, so
data and high-water marks advance together. Folders left by a failed run are
in no version and are never read.

Rows of a table with `block_by` are grouped into blocks, each a set of folders:

- RANGE: neighbouring ids (`id div block_rows`). A block holds at most
  `block_rows` ids, whatever the data look like, and ids are given in time
  order, so changes meet in few, recent blocks.
- HASH: a fixed number of blocks by a hash of the column. Rows of one parent
  lie in one block, and no set of ids makes more blocks.
- PERIOD: a block for each month (or day) of a stamp; rows without one are in
  block 0.

Reads, rewrites and deletes open only the blocks that their keys lie in. A
block that has gathered many small folders is written anew as one (`_merge`).
A table whose natural key says nothing about its block has an index: (natural
key, id) in a table of its own, by a hash of the natural key.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections import Counter
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyfold.schemas import HASH, PERIOD, RANGE, Table, key_index
from tallyfold.session import stage, writing

BLOCK = "_block"
# A block with so many folders of one level gets one of the next level instead.
CROWDED = 8
MONTH, DAY = "month", "day"
# Sizes of a bloom filter to choose from: 1 MB and halves of it, the least 2 kB.
BLOOM_SIZES = 10


class ConflictError(RuntimeError):
    """Another writer published a version first."""


class _Folder:
    """The few file operations needed, through the file system Spark uses."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._root = root.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}".rstrip("/"))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write under a private name, then rename; False when the name is taken.

        The rename itself fails if the target exists, so of two writers one wins; the loser's draft is removed.
        """
        draft = f"{name}.{uuid.uuid4().hex}"
        self.write(draft, text)
        fs = self._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        keep = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            files.rename(files.makeQualified(self._path(draft)), files.makeQualified(self._path(name)), keep)
        except Py4JJavaError as error:
            self._fs.delete(self._path(draft), False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True

    def children(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(name)) if s.isDirectory()]


class TableStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, Table],
        block_rows: int = 1 << 20,
        buckets: int = 64,
        period: str = MONTH,
    ):
        if period not in (MONTH, DAY):
            raise ValueError(f"unknown period {period!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables
        self.indexes = {t.name: key_index(t) for t in tables.values() if t.indexed}
        self.layout = {"block_rows": block_rows, "buckets": buckets, "period": period}
        self._folder = _Folder(spark, root)

    # -- versions ---------------------------------------------------------
    def latest(self) -> int:
        """Number of the newest version, 0 when there is none."""
        number = 0
        if self._folder.exists("_versions/hint"):
            number = int(self._folder.read("_versions/hint"))
        while self._folder.exists(f"_versions/{number + 1}.json"):
            number += 1
        return number

    def version(self, number: int | None = None) -> dict:
        number = self.latest() if number is None else number
        if number == 0:
            return {"version": 0, "tables": {}}
        return json.loads(self._folder.read(f"_versions/{number}.json"))

    def _publish(self, content: dict) -> None:
        number = content["version"]
        if not self._folder.publish(f"_versions/{number}.json", json.dumps(content)):
            raise ConflictError(f"version {number} exists already")
        self._folder.write("_versions/hint", str(number))

    # -- access -----------------------------------------------------------
    def read(self, table: str, version: int | None = None, since: str | None = None) -> DataFrame:
        return Transaction(self, self.version(version)).read(table, since=since)

    def begin(self) -> "Transaction":
        return Transaction(self, self.version())


class Transaction:
    """A set of table changes published together. Reads see the changes so far."""

    def __init__(self, store: TableStore, base: dict):
        self.store = store
        self.spark = store.spark
        self._content = copy.deepcopy(base)
        self._content["version"] = base["version"] + 1

    def table(self, name: str) -> Table:
        if name in self.store.tables:
            return self.store.tables[name]
        return next(i for i in self.store.indexes.values() if i.name == name)

    def _entry(self, name: str) -> dict:
        return self._content["tables"].setdefault(name, {"parts": [], "high_key": 0, **self.store.layout})

    # -- notes ------------------------------------------------------------
    def noted(self, name: str) -> int | None:
        """A number published with the tables under this name."""
        return self._content.get("notes", {}).get(name)

    def note(self, name: str, value: int) -> None:
        self._content.setdefault("notes", {})[name] = value

    def exists(self, name: str) -> bool:
        return name in self._content["tables"]

    def create(self, name: str) -> None:
        """Declare an empty table; keeps one that exists."""
        self._entry(name)

    # -- reading ----------------------------------------------------------
    def read(self, name: str, blocks: Iterable[int] | None = None, since: str | None = None) -> DataFrame:
        """Rows of a table.

        `blocks` limits the read to those blocks; `since` skips folders whose
        newest row is older (single rows are not filtered).
        """
        parts = self._entry(name)["parts"]
        if blocks is not None:
            wanted = set(blocks)
            parts = [p for p in parts if p["block"] in wanted]
        if since is not None:
            parts = [p for p in parts if p["newest"] is None or p["newest"] >= since]
        return self._scan(name, parts)

    def _scan(self, name: str, parts: list[dict]) -> DataFrame:
        schema = self.table(name).schema
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.store.root}/{p['path']}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)

    def blocks(self, name: str) -> set[int]:
        return {p["block"] for p in self._entry(name)["parts"]}

    def block_of(self, name: str, column: str | None = None) -> Column:
        """Block number of a row, from the column that the table is grouped by."""
        table, entry = self.table(name), self._entry(name)
        source = F.col(column or table.block_by)
        if table.layout == HASH:
            kind = table.column(table.block_by).type
            return F.pmod(F.xxhash64(source.cast(kind)), F.lit(entry["buckets"]).cast("long"))
        if table.layout == PERIOD:
            month = F.year(source) * 100 + F.month(source)
            return F.coalesce(month if entry["period"] == MONTH else month * 100 + F.day(source), F.lit(0)).cast("long")
        return F.expr(f"`{column or table.block_by}` div {entry['block_rows']}")

    def blocks_of(self, name: str, rows: DataFrame, column: str | None = None) -> set[int]:
        """Blocks that exist and may hold rows with the values that `rows` has in the column the table is grouped by."""
        known = self.blocks(name)
        if not known:
            return known
        return known & {r[0] for r in rows.select(self.block_of(name, column).alias(BLOCK)).distinct().collect()}

    def ids_of(self, name: str, rows: DataFrame) -> DataFrame:
        """(natural key, id) of the stored rows whose natural key may occur in `rows`; other rows may be among them.

        With an index only the blocks of these keys are opened.
        """
        table = self.table(name)
        index = self.store.indexes.get(name)
        if index:
            return self.read(index.name, self.blocks_of(index.name, rows))
        blocks = self.blocks_of(name, rows) if table.block_by == table.natural_key else None
        return self.read(name, blocks).select(table.natural_key, table.key)

    # -- keys -------------------------------------------------------------
    def high_key(self, name: str) -> int:
        """Largest generated key handed out so far."""
        return self._entry(name)["high_key"]

    def raise_high_key(self, name: str, value: int) -> None:
        entry = self._entry(name)
        entry["high_key"] = max(entry["high_key"], value)

    # -- writing ----------------------------------------------------------
    def _write(self, name: str, df: DataFrame, level: int = 0, in_place: bool = False) -> list[dict]:
        """Write a folder and return its parts, none for no rows.

        Whether there are rows, and their newest stamp, is observed during the write. `in_place` says that rows come as
        they lie in the blocks, so that they need not move.
        """
        table = self.table(name)
        path = f"{name}/{uuid.uuid4().hex}"
        seen = Observation()
        newest = F.max(table.stamp) if table.stamp else F.lit(None).cast("timestamp_ntz")
        rows = df.select(*table.names).observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest"))
        if table.block_by:
            rows = rows.withColumn(BLOCK, self.block_of(name))
            if table.layout != RANGE:
                # Few files for each block, a hot block in several; sorted, so that statistics skip row groups.
                moved = rows if in_place else rows.hint("rebalance", F.col(BLOCK))
                rows = moved.sortWithinPartitions(BLOCK, table.block_by)
            writer = rows.write.partitionBy(BLOCK)
        else:
            writer = rows.write
        if table.natural_key and table.column(table.natural_key).type.typeName() == "string":
            # Stands in for the unique index: point reads skip row groups. As large as the row group needs: of a fixed
            # size it would be 1 MB in each file, however small.
            writer = writer.option(f"parquet.bloom.filter.enabled#{table.natural_key}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            writer = writer.option("parquet.bloom.filter.candidates.number", str(BLOOM_SIZES))
        with writing(df.sparkSession):
            writer.parquet(f"{self.store.root}/{path}", compression="zstd")
        found = [path]
        if table.block_by:
            # Without rows there are no folders, and an exchange that is empty at run time leaves nothing observed.
            found = sorted(f"{path}/{c}" for c in self.store._folder.children(path) if c.startswith(f"{BLOCK}="))
        if not found or not seen.get["rows"]:
            return []
        stamp = seen.get["newest"]
        common = {"newest": stamp.isoformat(sep=" ") if stamp else None, "level": level}
        return [{"path": p, "block": int(p.rsplit("=", 1)[1]) if table.block_by else None, **common} for p in found]

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows and return them as stored; nothing that exists is changed.

        In a table of id ranges, rows of a block should lie in few tasks, as each
        task writes a file for each block it holds rows of.
        """
        added = self._write(name, df)
        self._entry(name)["parts"].extend(added)
        rows = self._scan(name, added)
        index = self.store.indexes.get(name)
        if index and added:
            self.append(index.name, rows.select(*index.names))
        self._merge(name)
        return rows

    def _merge(self, name: str) -> None:
        """Write the folders of each crowded block as one folder of the next level.

        Levels keep the work small: a row is written once more for each level, of which a block has as many as the
        logarithm of its appends, and a block never has more than CROWDED folders of a level.
        """
        entry = self._entry(name)
        level = 0
        while self.table(name).block_by and any(p["level"] >= level for p in entry["parts"]):
            at = Counter(p["block"] for p in entry["parts"] if p["level"] == level)
            full = {b for b, n in at.items() if n >= CROWDED}
            small = [p for p in entry["parts"] if p["level"] == level and p["block"] in full]
            if small:
                merged = self._write(name, self.gather_blocks(name, self._scan(name, small)), level + 1)
                entry["parts"] = [p for p in entry["parts"] if p not in small] + merged
            level += 1

    def gather_blocks(self, name: str, df: DataFrame) -> DataFrame:
        """Rows of a table of id ranges, each block in one task. A block has a bounded number of ids."""
        if self.table(name).layout != RANGE:
            return df
        return df.withColumn(BLOCK, self.block_of(name)).repartition(BLOCK).drop(BLOCK)

    def rewrite_blocks(
        self, name: str, df: DataFrame, blocks: Iterable[int], keys_change: bool = False, in_place: bool = False
    ) -> None:
        """Replace the rows of the named blocks by `df`, which holds no others.

        `keys_change` says that natural keys or ids come, go or change, so that the index has to follow. In a table of id
        ranges rows of a block should lie in few tasks, as in `append`; for `in_place` see `_write`.
        """
        gone = set(blocks)
        entry = self._entry(name)
        before = [p for p in entry["parts"] if p["block"] in gone]
        added = self._write(name, df, in_place=in_place)
        entry["parts"] = [p for p in entry["parts"] if p["block"] not in gone] + added
        index = self.store.indexes.get(name)
        if index and keys_change:
            old, new = (self._scan(name, parts).select(*index.names) for parts in (before, added))
            lost = stage(old.exceptAll(new), "lost")
            touched = self.blocks_of(index.name, lost)
            if touched:
                kept = self.read(index.name, touched).join(lost, index.names, "left_anti")
                self.rewrite_blocks(index.name, kept, touched)
            self.append(index.name, new.exceptAll(old))

    def replace(self, name: str, df: DataFrame) -> None:
        """Replace a whole table without an index; meant for small ones."""
        self._entry(name)["parts"] = self._write(name, df)

    def clear(self, name: str) -> None:
        for gone in (name, *([self.store.indexes[name].name] if name in self.store.indexes else [])):
            self._content["tables"].pop(gone, None)
            self._entry(gone)

    def commit(self) -> int:
        self.store._publish(self._content)
        return self._content["version"]
