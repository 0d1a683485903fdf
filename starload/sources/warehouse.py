"""Target tables on Parquet, published by switching one pointer per table.

Parquet tables take no MERGE, UPDATE or DELETE. A load therefore writes new files
beside the ones in use and then names the files that make up the table in a new
pointer. A load that fails before that leaves the table as it was, and a reader of
the table sees either all of it or none. Tables are published one by one: a load that
fails at its fact leaves its new members, which a rerun finds.

The file system must refuse to rename a file onto one that exists, as HDFS and local
ones do; stores that copy instead would let two writers of a table both succeed.

Facts are kept in hash buckets of their natural key, and an upsert rewrites only
the buckets its batch touches. Of two writers of a table the later one is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.checks import verify, verify_members
from starload.operators.keys import assign_bucket_keys, bucket, highest
from starload.operators.merge import Conflict, absent
from starload.schemas import TABLES, conform, empty
from starload.session import materialize

BUCKET = "kb"
_WHOLE = "all"
# Folders a dimension or bucket may have before a load writes them as one, and pointers kept.
_FOLDERS = 8
_POINTERS = 8
# Members of a page of a dimension's files, the least a scan by member reads.
_PAGE_ROWS = 500


class Warehouse:
    """The published tables below a root folder all executors share."""

    by_member = True

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None,
                 check: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        # With as many buckets as shuffle partitions, the last shuffle of a load
        # leaves one bucket per task. A table keeps the number it began with.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.check = check
        # Of a load: the pointers it works on, by table. Else reads see the newest ones.
        self._held: dict[str, dict] | None = None
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def begin(self) -> Warehouse:
        """The tables as one load sees them.

        A table is held as it was when the load first read it, until the load itself
        publishes it. Publishing over what another writer did meanwhile is refused.
        """
        load = Warehouse(self.spark, self.root, self.buckets, self.check)
        load._held = {}
        return load

    def _current(self, name: str) -> dict:
        if self._held is None:
            return self._pointer(name)
        return self._held.setdefault(name, self._pointer(name))

    # Pointers: <table>/_pointer/<number>.json, the highest number is current.

    def _numbers(self, name: str) -> list[int]:
        folder = self._path(f"{self.root}/{name}/_pointer")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _pointer(self, name: str) -> dict:
        numbers = self._numbers(name)
        if not numbers:
            return {"number": 0, "buckets": self.buckets, "parts": {}, "top": 0}
        path = self._path(f"{self.root}/{name}/_pointer/{numbers[-1]}.json")
        stream = self._fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {"number": numbers[-1], "top": 0, **json.loads(text)}

    def _switch(self, name: str, pointer: dict, parts: dict[str, list[str]], top: int = 0) -> None:
        """Make ``parts`` the table; fail if another writer was first.

        ``top`` is the highest surrogate key in it. The pointer keeps the highest one ever, as a
        key that was purged must not name another member.
        """
        folder = f"{self.root}/{name}/_pointer"
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}")
        final = self._path(f"{folder}/{pointer['number'] + 1}.json")
        top = max(top, pointer["top"])
        body = json.dumps({"buckets": pointer["buckets"], "parts": parts, "top": top})
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(body, "utf-8"))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"{name} was published by another writer meanwhile")
        if self._held is not None:
            self._held[name] = {
                "number": pointer["number"] + 1, "buckets": pointer["buckets"], "parts": parts, "top": top,
            }
        self._drop_old_pointers(name, pointer["number"])

    def _drop_old_pointers(self, name: str, number: int) -> None:
        """Keep the newest pointers only: readers open one at once, and name files by it."""
        for old in self._numbers(name):
            if old <= number - _POINTERS:
                self._fs.delete(self._path(f"{self.root}/{name}/_pointer/{old}.json"), False)

    def top(self, name: str) -> int | None:
        """The highest surrogate key the table ever had; None if it is not recorded."""
        pointer = self._current(name)
        return pointer["top"] or (None if pointer["parts"] else 0)

    # Reading

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name))

    def _load(self, name: str, paths: list[str]) -> DataFrame:
        if not paths:
            return empty(self.spark, name)
        return self.spark.read.schema(TABLES[name].schema).parquet(
            *[f"{self.root}/{name}/{p}" for p in paths]
        )

    def read(self, name: str) -> DataFrame:
        """The published table, empty but with its columns before its first load."""
        pointer = self._current(name)
        paths = {p for paths in pointer["parts"].values() for p in paths}
        return self._load(name, sorted(paths))

    def _near(self, name: str, rows: DataFrame, pointer: dict) -> DataFrame:
        near = rows.select(bucket(TABLES[name].placed, pointer["buckets"]).alias("b")).distinct()
        # At most one row per bucket reaches the driver.
        touched = [str(row["b"]) for row in near.collect()]
        return self._load(name, [p for b in touched for p in pointer["parts"].get(b, [])])

    def read_near(self, name: str, rows: DataFrame) -> DataFrame:
        """Of a fact, the buckets that hold the rows placed as ``rows`` are."""
        return self._near(name, rows, self._current(name))

    def members(self, name: str, column: str, values: list | None) -> DataFrame:
        """Of a dimension, the members with one of a few values; all of them for None.

        Members are written in the order of their natural key in small pages, so that the scan
        reads the pages around the values only.
        """
        members = self.read(name)
        return members if values is None else members.filter(F.col(column).isin(values))

    # Writing

    def _write(self, name: str, df: DataFrame) -> str:
        version = f"data/{uuid.uuid4().hex}"
        writer = conform(df, name).write
        if TABLES[name].surrogate and not TABLES[name].fact:
            writer = writer.option("parquet.page.row.count.limit", str(_PAGE_ROWS))
        writer.parquet(f"{self.root}/{name}/{version}")
        return version

    def _write_buckets(self, name: str, df: DataFrame, buckets: int) -> dict[str, str]:
        """Write by bucket; returns bucket -> folder for the buckets written."""
        version = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{version}"
        df = conform(df, name).withColumn(BUCKET, bucket(TABLES[name].placed, buckets))
        df.write.partitionBy(BUCKET).parquet(path)
        folders = [f.getPath().getName() for f in self._fs.listStatus(self._path(path))]
        prefix = BUCKET + "="
        return {f[len(prefix):]: f"{version}/{f}" for f in folders if f.startswith(prefix)}

    def create(self, *names: str) -> None:
        """Publish the named tables without rows, where they do not exist."""
        for name in names:
            if not self.exists(name):
                self.replace(name, empty(self.spark, name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows that are known to be new; the files in use stay.

        Rows keyed by what a load has read are refused if the table has changed since.
        """
        version = self._write(name, rows)
        keyed = TABLES[name].surrogate is not None
        pointer = self._current(name) if keyed else self._pointer(name)
        written = self._load(name, [version])
        if pointer["number"] and written.isEmpty():
            return
        top = self._check_members(name, written)
        for last in (False, False, False, True):
            parts = dict(pointer["parts"])
            paths = [*parts.get(_WHOLE, []), version]
            if len(paths) > _FOLDERS:
                paths = [self._write(name, self._load(name, paths).coalesce(_FOLDERS))]
            parts[_WHOLE] = paths
            try:
                return self._switch(name, pointer, parts, top)
            except Conflict:
                if keyed or last:
                    raise
                pointer = self._pointer(name)

    def put_run(self, name: str, run_id: str, rows: DataFrame | None) -> None:
        """Make ``rows`` what the run left in a table of runs, in place of what it left before.

        The newest runs have folders of their own; older ones share some, from which an old
        run that is repeated is taken out. No rows: the run leaves nothing.
        """
        rows = None if rows is None else rows.withColumn("run_id", F.lit(run_id))
        version = None if rows is None else self._write(name, rows)
        for last in (False, False, False, True):
            pointer = self._pointer(name)
            # One entry per run: which came first is told by a number before its id.
            parts = {k: v for k, v in pointer["parts"].items() if k.partition(":")[2] != run_id}
            whole = parts.get(_WHOLE, [])
            if whole and not self._load(name, whole).filter(F.col("run_id") == run_id).isEmpty():
                others = self._load(name, whole).filter(~F.col("run_id").eqNullSafe(F.lit(run_id)))
                parts[_WHOLE] = whole = [self._write(name, others)]
            if version is None and parts == pointer["parts"]:
                return
            if version is not None:
                parts[f"{pointer['number']:012d}:{run_id}"] = [version]
            own = sorted(k for k in parts if k != _WHOLE)
            if len(own) > _FOLDERS:
                old = [p for k in own for p in parts.pop(k)]
                rest = self._load(name, [*whole, *old]).coalesce(_FOLDERS)
                parts[_WHOLE] = [self._write(name, rest)]
            try:
                return self._switch(name, pointer, parts)
            except Conflict:
                if last:
                    raise

    def replace(self, name: str, df: DataFrame) -> None:
        """Put a whole new table in place, unless it changed since it was read."""
        pointer = self._current(name)
        if TABLES[name].fact:
            written = self._write_buckets(name, df, pointer["buckets"])
            self._switch(name, pointer, {b: [folder] for b, folder in written.items()})
        else:
            version = self._write(name, df)
            top = self._check_members(name, self._load(name, [version]))
            self._switch(name, pointer, {_WHOLE: [version]}, top)

    def _check_members(self, name: str, rows: DataFrame) -> int:
        """Refuse members that repeat a key or are too long; returns their highest key."""
        surrogate = TABLES[name].surrogate
        if surrogate is None or not self.check:
            return 0 if surrogate is None else highest(rows, surrogate)
        return verify_members(rows, name)

    def _check(self, name: str, rows: DataFrame) -> None:
        if self.check:
            verify(rows, name, self.read)

    def upsert(self, name: str, batch: DataFrame) -> int:
        """Add or replace rows by natural key; returns their number.

        The batch is written once, by bucket. Of the stored rows only those in a
        bucket of the batch are read, and written again without the replaced ones.
        """
        pointer = self._current(name)
        parts = dict(pointer["parts"])
        written = self._write_buckets(name, batch, pointer["buckets"])
        rows = self._load(name, list(written.values()))
        self._check(name, rows)
        near = [p for b in written for p in parts.get(b, [])]
        survivors = {}
        if near:
            left = absent(self._load(name, near), rows, TABLES[name].natural)
            survivors = self._write_buckets(name, left, pointer["buckets"])
        for b, folder in written.items():
            parts[b] = [folder, survivors[b]] if b in survivors else [folder]
        self._switch(name, pointer, parts)
        return rows.count()

    def insert_absent(self, name: str, batch: DataFrame) -> int:
        """Add rows whose natural key is not stored, beside the files in use.

        Returns the number of rows added.
        """
        contract = TABLES[name]
        pointer = self._current(name)
        parts = dict(pointer["parts"])
        staged = materialize(conform(batch, name), f"batch-{name}")
        self._check(name, staged)
        stored = self._near(name, staged, pointer)
        fresh = absent(staged, stored, contract.natural)
        if contract.surrogate:
            fresh = assign_bucket_keys(
                fresh, stored, contract.natural, contract.surrogate, pointer["buckets"]
            )
        written = self._write_buckets(name, fresh, pointer["buckets"])
        added = self._load(name, list(written.values())).count()
        for b, folder in written.items():
            parts[b] = [*parts.get(b, []), folder]
        # Buckets that many small batches built up are written as one folder again.
        full = [b for b in written if len(parts[b]) > _FOLDERS]
        if full:
            rows = self._load(name, [p for b in full for p in parts[b]])
            whole = self._write_buckets(name, rows.repartition(*contract.placed), pointer["buckets"])
            parts.update({b: [folder] for b, folder in whole.items()})
        self._switch(name, pointer, parts)
        return added

    def compact(self, name: str) -> None:
        """Rewrite buckets and dimensions that many small appends have built up."""
        pointer = self._pointer(name)
        parts = dict(pointer["parts"])
        many = [b for b, paths in parts.items() if len(paths) > 1]
        if not many:
            return
        rows = self._load(name, [p for b in many for p in parts[b]])
        if many == [_WHOLE]:
            parts[_WHOLE] = [self._write(name, rows)]
        else:
            merged = rows.repartition(*TABLES[name].placed)
            for b, folder in self._write_buckets(name, merged, pointer["buckets"]).items():
                parts[b] = [folder]
        self._switch(name, pointer, parts)

    def vacuum(self, name: str) -> None:
        """Delete files the current pointer does not name.

        For quiet times: a reader that began before the last load needs them.
        """
        used = {p for paths in self._pointer(name)["parts"].values() for p in paths}
        base = self._path(f"{self.root}/{name}/data")
        for version in self._fs.listStatus(base) if self._fs.exists(base) else []:
            whole = f"data/{version.getPath().getName()}"
            if whole in used:
                continue
            inside = [f.getPath() for f in self._fs.listStatus(version.getPath())]
            unused = [p for p in inside if f"{whole}/{p.getName()}" not in used]
            if len(unused) == len(inside):
                self._fs.delete(version.getPath(), True)
            else:
                for path in unused:
                    self._fs.delete(path, True)


def merge_catalog_table(batch: DataFrame, table: str, key: list[str], update: bool = True) -> None:
    """The same merge for a catalog table that supports row-level operations.

    With ``update`` stored rows are replaced, without it they stay as they are.
    """
    on = None
    for column in key:
        same = F.col(f"{table}.{column}") == F.col(f"batch.{column}")
        on = same if on is None else on & same
    merge = batch.alias("batch").mergeInto(table, on)
    if update:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()

