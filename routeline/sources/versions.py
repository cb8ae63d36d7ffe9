"""Tables whose state is a small versioned list of folders: keyed merges and folded generations.

Data folders are written once and never changed. A new state is published by renaming one small file,
the list of the folders that make up the table, to the next version number. Readers see the old list
or the new one; a job that dies before the rename leaves folders that no list names, and of two
writers that publish the same version one fails. ``vacuum`` removes what the last lists don't name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from routeline.session import scratch_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class VersionConflict(RuntimeError):
    """Another writer published this version first."""


class Versions:
    """The versions of one table's list of folders, below ``path/_versions``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._lists = self._at("_versions")
        self._fs = self._lists.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._lists):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._lists)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())

    def load(self, version: int | None = None) -> dict | None:
        """The state of a version, by default of the newest; None for a table not yet written."""
        known = self.numbers()
        if not known:
            return None
        stream = self._fs.open(self._at("_versions", f"{known[-1] if version is None else version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, state: dict) -> dict:
        """Make ``state`` (with its ``version``) the newest one."""
        draft = self._at("_versions", f"_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        final = self._at("_versions", f"{state['version']:012d}.json")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise VersionConflict(f"{self.path}: version {state['version']} exists")
        return state

    def folders_below(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._at(folder)) if f.isDirectory()]

    def new_folder(self, version: int) -> str:
        return f"data/{version:012d}-{uuid.uuid4().hex}"

    def vacuum(self, named: Callable[[dict], Iterable[str]], keep: int = 2) -> int:
        """Remove all but the newest ``keep`` lists and the data folders that these don't name."""
        known = self.numbers()
        live = {name for v in known[-keep:] for name in named(self.load(v))}
        gone = []
        for folder in self.folders_below("data") if known else []:
            top = f"data/{folder}"
            inside = [f"{top}/{part}" for part in self.folders_below(top)]
            if top not in live:
                gone += [part for part in inside if part not in live] if live & set(inside) else [top]
        for path in [*gone, *(f"_versions/{v:012d}.json" for v in known[:-keep])]:
            self._fs.delete(self._at(path), True)
        return len(gone)


def _same(names: Iterable[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.`{name}`").eqNullSafe(F.col(f"{right}.`{name}`"))
    return condition


class KeyedTable:
    """A table with one row per key, merged copy-on-write by the partitions a merge touches."""

    def __init__(self, spark: SparkSession, path: str, key: tuple[str, ...], partition: str):
        self.spark, self.key, self.partition = spark, key, partition
        self.versions = Versions(spark, path)

    def partitions(self) -> list[str]:
        """Partition values as text, from the list alone."""
        return sorted((self.versions.load() or {}).get("folders", {}))

    def read(self, wanted: Callable[[str], bool] | None = None, state: dict | None = None) -> DataFrame | None:
        """The table, or the partitions whose value as text is ``wanted``; None if never written."""
        state = state or self.versions.load()
        if state is None:
            return None
        schema = StructType.fromJson(state["schema"])
        paths = [f"{self.versions.path}/{f}" for p, f in state["folders"].items() if wanted is None or wanted(p)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame], DataFrame] | None = None) -> dict:
        """Insert or replace ``rows``, one per key; the new state, or the old one if nothing changes.

        ``combine`` reduces the union of stored and new rows of the given keys to one row per key; by default the new
        row wins. Only partitions that lose or gain a changed row are written. Where keys are searched, the
        table is read by its key and partition columns alone.
        """
        state, stored = self.versions.load(), self._stored
        new = stored(rows, "merge-rows")
        names = new.columns
        changed, touched = new, []
        if state:
            old = self.read(state=state).select(*names)
            on = _same(self.key, "o", "n")
            where = old.select(*self.key, self.partition).alias("o").join(
                new.select(*self.key).alias("n"), on, "left_semi")
            parts = [r[0] for r in where.select(self._label()).distinct().collect()]
            met = self.read(lambda p: p in set(parts), state).select(*names).alias("o").join(
                new.select(*self.key).alias("n"), on, "left_semi")
            met = stored(met, "merge-met")
            result = combine(met.unionByName(new)).select(*names) if combine else new
            same = _same(names, "n", "o")
            changed = stored(result.alias("n").join(met.alias("o"), same, "left_anti"), "merge-changed")
            if changed.isEmpty():
                return state
            gone = met.alias("o").join(changed.select(*self.key).alias("n"), on, "left_semi")
            touched = [r[0] for r in gone.select(self._label()).union(
                changed.select(self._label())).distinct().collect()]
            kept = self.read(lambda p: p in set(touched), state).select(*names).alias("o").join(
                changed.select(*self.key).alias("n"), on, "left_anti")
            changed = kept.unionByName(changed)
        return self._publish(state, changed, touched, new.schema.jsonValue())

    def replace(self, rows: DataFrame, partitions: Iterable[str]) -> dict:
        """Make ``rows`` the whole content of ``partitions``, in which they lie; the others keep their files."""
        return self._publish(self.versions.load(), rows, set(partitions), rows.schema.jsonValue())

    def _publish(self, state: dict | None, rows: DataFrame, gone: Iterable[str], schema: dict) -> dict:
        versions, version = self.versions, state["version"] + 1 if state else 0
        folder = versions.new_folder(version)
        rows.withColumn("_part", F.col(self.partition)).hint("rebalance", "_part").write.partitionBy("_part").parquet(
            f"{versions.path}/{folder}")
        folders = {p: f for p, f in (state["folders"] if state else {}).items() if p not in gone}
        folders |= {name.removeprefix("_part="): f"{folder}/{name}" for name in versions.folders_below(folder)}
        return versions.publish({"version": version, "schema": state["schema"] if state else schema, "folders": folders})

    def vacuum(self, keep: int = 2) -> int:
        return self.versions.vacuum(lambda state: state["folders"].values(), keep)

    def _label(self) -> Column:
        return F.coalesce(F.col(self.partition).cast("string"), F.lit(NULL_PARTITION)).alias("p")

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


class Generations:
    """A keyed table fed by micro-batches, log-structured.

    A batch adds one generation, a folder with the rows it brings, dealt to hash buckets of the key. ``fan``
    generations of one level are folded into one of the next, so a table of n batches has fewer than
    fan * log(n) live generations, and a row is rewritten once per level. ``reduce`` brings rows of one
    key down to one; it must not depend on their order or grouping. A batch that is already in the list is not
    added again.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, reduce: Callable[[DataFrame], DataFrame],
                 fan: int = 4, buckets: int = 8):
        self.spark, self.key, self.reduce, self.fan, self.buckets = spark, key, reduce, fan, buckets
        self.versions = Versions(spark, path)

    def live(self) -> list[dict]:
        return (self.versions.load() or {"generations": []})["generations"]

    def add(self, rows: DataFrame, batch_id: int) -> None:
        state = self.versions.load() or {"version": -1, "batch": -1, "generations": []}
        if batch_id <= state["batch"]:
            return
        rows = self.reduce(rows)
        live = [*state["generations"], self._write(rows, state["version"] + 1, 0)]
        level = 0
        while len(fold := [g for g in live if g["level"] == level]) >= self.fan:
            merged = self._write(self.reduce(self._read(fold, rows.schema)), state["version"] + 1, level + 1)
            live = [*[g for g in live if g not in fold], merged]
            level += 1
        self.versions.publish({"version": state["version"] + 1, "batch": batch_id, "generations": live,
                               "schema": rows.schema.jsonValue()})

    def read(self, key: str | None = None) -> DataFrame | None:
        """One row per key; with ``key`` only that key's bucket is opened."""
        state = self.versions.load()
        if state is None:
            return None
        return self.reduce(self._read(state["generations"], StructType.fromJson(state["schema"]), key))

    def vacuum(self, keep: int = 2) -> int:
        return self.versions.vacuum(lambda state: [g["folder"] for g in state["generations"]], keep)

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int, level: int) -> dict:
        folder = self.versions.new_folder(version)
        bucket = self._bucket(F.col(self.key))
        # a bucket is dealt to several tasks: streams run without adaptive execution, which would split large ones
        spread = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(spread))
        rows.withColumn("_bucket", bucket).repartition("_bucket", part).write.partitionBy("_bucket").parquet(
            f"{self.versions.path}/{folder}")
        return {"folder": folder, "level": level}

    def _read(self, generations: list[dict], schema: StructType, key: str | None = None) -> DataFrame:
        found = self.spark.createDataFrame([], schema)
        for g in generations:
            rows = self.spark.read.schema(StructType([*schema, StructField("_bucket", IntegerType())])).parquet(
                f"{self.versions.path}/{g['folder']}")
            if key is not None:
                rows = rows.filter((F.col("_bucket") == self._bucket(F.lit(key))) & (F.col(self.key) == key))
            found = found.unionByName(rows.drop("_bucket"))
        return found
