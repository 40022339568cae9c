"""Keyed tables kept as versioned Parquet folders.

A version is a small JSON file that names, per part of the table, the Parquet
folder holding it. A write produces new folders for the parts it touches and
then one new version file, so a reader sees either all of it or none, no job
overwrites what it reads, and earlier versions stay readable until rotated
out. A part is any deterministic value of a row (an event day, a model
bucket): an upsert rewrites only parts that receive rows or hold a matched key.

A version also holds

* the columns of the table, so that columns which a batch adds stay, and an
  older version still reads as it was;
* per part its rows and the least and greatest value of the ``zone`` column, so
  that a purge reads only the parts which its cutoff divides;
* with ``index_rows``, the folders of a key index: rows of (key, part) in hash
  buckets, of which an upsert reads only those its batch falls into.

Several tables in one :class:`SnapshotGroup` are committed together.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import last_wins, merge_rows
from tidemark.session import empty_table, observed, stage, unstage
from tidemark.sources import paths

NO_PART = "all"
# A bucket of the key index is written anew once it has grown by so many folders.
INDEX_FOLDERS = 8
# An upsert starts again from the newer version when another writer was first.
ATTEMPTS = 5


@dataclass(frozen=True)
class Version:
    number: int = 0
    parts: dict[str, list[str]] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    columns: dict | None = None  # stored schema as JSON
    rows: int = 0
    zones: dict[str, list] = field(default_factory=dict)  # part -> [rows, without a value, least, greatest]
    index: dict | None = None  # {"bits", "rows", "buckets": {bucket: [folders]}}

    def folders(self) -> set[str]:
        data = {f for folders in self.parts.values() for f in folders}
        return data | {f for folders in (self.index or {"buckets": {}})["buckets"].values() for f in folders}


def by_day(epoch_ms: str) -> Callable[[], Column]:
    """Parts by UTC day of an epoch-millisecond column."""
    return lambda: F.coalesce(F.date_format(F.timestamp_millis(F.col(epoch_ms)), "yyyy-MM-dd"), F.lit("none"))


def by_bucket(column: str, buckets: int) -> Callable[[], Column]:
    """Parts by hash bucket of a column that never changes for a key."""
    return lambda: F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string")


def by_bucket_and_year(column: str, buckets: int, date_text: str) -> Callable[[], Column]:
    """Parts by hash bucket and the year a text date begins with; neither may change for a key."""
    year = F.regexp_extract(F.coalesce(F.col(date_text), F.lit("")), "^[0-9]{4}", 0)
    return lambda: F.concat_ws("-", by_bucket(column, buckets)(), F.when(year == "", "none").otherwise(year))


class SnapshotTable:
    """One table: ``key`` is unique, ``part`` groups rows into folders.

    ``schema`` holds the columns every version has. Where the part of a key never
    changes (``moves=False``) an upsert looks for its keys in its own parts only.
    Otherwise ``index_rows`` is the number of keys a bucket of the key index
    should hold; without it an upsert looks through the keys of all rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str | None = None,
        part: Callable[[], Column] | None = None, *, moves: bool = True, zone: str | None = None,
        index_rows: int | None = None, group: SnapshotGroup | None = None,
    ):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.part = part or (lambda: F.lit(NO_PART))
        self.moves = moves and part is not None
        self.zone, self.index_rows, self.group = zone, index_rows, group
        # Of the last write: rows written, and what an upsert or purge looked at.
        self.last: dict[str, int] = {}
        if group is not None:
            group.add(self)

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    # -- versions ---------------------------------------------------------
    def stored_numbers(self) -> list[int]:
        """Versions in the folder, also those that no group has committed."""
        return [int(n.removesuffix(".json")) for n in paths.names(self.spark, f"{self.path}/versions") if n.endswith(".json") and not n.startswith(".")]

    def version_numbers(self) -> list[int]:
        known = self.stored_numbers()
        if self.group is None:
            return known
        live = set(self.group.named(self.name))
        return [n for n in known if n in live]

    def _newest(self) -> int | None:
        if self.group is not None:
            return self.group.current(self.name)
        return max(self.stored_numbers(), default=None)

    def version(self, number: int | None = None) -> Version:
        number = self._newest() if number is None else number
        if number is None:
            return Version()
        stored = json.loads(paths.read_text(self.spark, f"{self.path}/versions/{number:08d}.json"))
        return Version(number, **stored)

    def exists(self) -> bool:
        return self._newest() is not None

    def _commit(self, base: Version, new: Version) -> Version:
        """Publish the next version; fails if another writer got there first.

        In a group the version is only seen once the group commits it.
        """
        body = {k: getattr(new, k) for k in ("parts", "properties", "columns", "rows", "zones", "index")}
        number = base.number + 1 if self.group is None else max(self.stored_numbers(), default=0) + 1
        paths.create_text(self.spark, f"{self.path}/versions/{number:08d}.json", json.dumps(body, sort_keys=True))
        if self.group is not None:
            self.group.record(self.name, number)
        return Version(number, **body)

    def _attempt(self, write: Callable[[], Version | int]) -> Version | int:
        for attempt in range(ATTEMPTS):
            try:
                return write()
            except paths.AlreadyThere:
                if self.group is not None or attempt == ATTEMPTS - 1:
                    raise
        raise AssertionError

    # -- columns ----------------------------------------------------------
    def columns(self, number: int | None = None) -> T.StructType:
        """Columns of the newest version and of the declared schema, or of an older version alone."""
        return self._columns(self.version(number), declared=number is None)

    def _columns(self, version: Version, declared: bool = True, batch: DataFrame | None = None) -> T.StructType:
        """Declared columns first, then those added by batches; a stored type stays as it is."""
        stored = T.StructType.fromJson(version.columns) if version.columns else T.StructType([])
        if not declared and version.columns:
            return stored
        types = {f.name.lower(): f for f in stored.fields}
        fields = [types.get(f.name.lower(), f) for f in self.schema.fields]
        known = {f.name.lower() for f in fields}
        for f in [*stored.fields, *(batch.schema.fields if batch is not None else [])]:
            if f.name.lower() not in known:
                fields.append(T.StructField(f.name, f.dataType))
                known.add(f.name.lower())
        return T.StructType(fields)

    # -- reading ----------------------------------------------------------
    def read(self, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """A version (the newest if not given), or only some of its parts."""
        version = self.version(number)
        wanted = version.parts if parts is None else [p for p in parts if p in version.parts]
        return self._read(version.parts, wanted, self._columns(version, declared=number is None))

    def _read(self, held: dict[str, list[str]], wanted, schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/data/{f}" for p in wanted for f in held[p]]
        if not folders:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # -- writing ----------------------------------------------------------
    def _write(self, rows: DataFrame, schema: T.StructType) -> tuple[dict[str, list[str]], dict[str, list]]:
        """Write rows to fresh folders, evenly sized files within each part; returns parts and their zones."""
        run = uuid.uuid4().hex
        present = {c.lower() for c in rows.columns}
        shaped = rows.selectExpr(*[
            f"CAST({f'`{f.name}`' if f.name.lower() in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields
        ])
        seen = Observation()
        shaped = shaped.withColumn("_part", self.part()).hint("rebalance", F.col("_part"))
        shaped.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("_part").parquet(f"{self.path}/data/{run}")
        self.last["rows_written"] = observed(seen).get("rows", 0)
        written = [n for n in paths.names(self.spark, f"{self.path}/data/{run}") if n.startswith("_part=")]
        parts = {n.removeprefix("_part="): [f"{run}/{n}"] for n in written}
        if self.zone is None or not parts:
            return parts, {}
        value = F.col(self.zone)
        stored = self.spark.read.schema(T.StructType([schema[self.zone], T.StructField("_part", T.StringType())]))
        spans = stored.parquet(f"{self.path}/data/{run}").groupBy(F.col("_part").alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(value.isNull()).alias("none"), F.min(value).alias("low"), F.max(value).alias("high")
        )
        return parts, {r["p"]: [r["n"], r["none"], r["low"], r["high"]] for r in spans.collect()}

    def replace(self, rows: DataFrame, properties: dict[str, str] | None = None, evolve: bool = False) -> Version:
        """Make ``rows`` the whole table."""
        schema = self._columns(self.version(), batch=rows if evolve else None)
        parts, zones = self._write(rows, schema)
        total = self.last["rows_written"]
        index = self._index_all(parts, schema, total)

        def commit() -> Version:
            base = self.version()
            return self._commit(base, Version(0, parts, {**base.properties, **(properties or {})}, schema.jsonValue(), total, zones, index))

        return self._attempt(commit)

    def upsert(
        self, batch: DataFrame, *, update: Sequence[str] | None = None, not_older: str | None = None,
        maps: dict[str, Sequence[str]] | None = None, properties: dict[str, str] | None = None, evolve: bool = False,
        staged: bool = False,
    ) -> Version:
        """Merge a batch that holds one row per key.

        ``staged``: the batch reads staged files alone and is not written once more.

        The stored keys are probed first, by the key index if there is one, to
        find the parts to rewrite; the rest is carried over. Columns the table
        lacks are added with ``evolve`` and left out otherwise.
        """
        if staged:
            rows = batch.count()
            return self._attempt(lambda: self._upsert(batch, rows, update, not_older, maps, properties, evolve))
        seen = Observation()
        batch = stage(batch.observe(seen, F.count(F.lit(1)).alias("rows")), "batch")
        rows = observed(seen).get("rows", 0)
        try:
            return self._attempt(lambda: self._upsert(batch, rows, update, not_older, maps, properties, evolve))
        finally:
            unstage(batch)

    def _upsert(self, batch, rows, update, not_older, maps, properties, evolve) -> Version:
        base = self.version()
        schema = self._columns(base, batch=batch if evolve else None)
        properties = {**base.properties, **(properties or {})}
        if not base.parts:
            parts, zones = self._write(batch, schema)
            return self._commit(
                base, Version(0, parts, properties, schema.jsonValue(), rows, zones, self._index_all(parts, schema, rows))
            )

        keys, asked = batch.select(self.key), None
        if base.index:
            asked = {r["_part"] for r in self._indexed(base, batch).union(self._new_parts(batch, schema)).distinct().collect()}
        elif not self.moves:
            asked = {r["_part"] for r in self._new_parts(batch, schema).distinct().collect()}
        # The index may name a part that a row has left, so the parts themselves are asked in any case.
        probed = sorted(base.parts if asked is None else asked & set(base.parts))
        probe = self._read(base.parts, probed, schema).select(self.key, self.part().alias("_part"))
        seen = Observation()
        matched = probe.join(keys, self.key, "left_semi").observe(seen, F.count(F.lit(1)).alias("rows"))
        matched = stage(matched, "matched")
        total = base.rows + rows - observed(seen).get("rows", 0)
        touched = asked
        if touched is None:
            touched = {r["_part"] for r in matched.select("_part").union(self._new_parts(batch, schema)).distinct().collect()}
        rewritten = sorted(touched & set(base.parts))
        merged = merge_rows(
            self._read(base.parts, rewritten, schema), batch, self.key, update=update, not_older=not_older, maps=maps, matched=matched,
        )
        parts, zones = self._write(merged, schema)
        carried = {p: f for p, f in base.parts.items() if p not in touched}
        kept_zones = {p: z for p, z in base.zones.items() if p in carried}
        held = {**carried, **parts}
        if base.index:
            index = self._index_more(base, matched, keys, parts, schema, total)
        else:
            index = self._index_all(held, schema, total)
        self.last |= {"parts_read": len(rewritten), "parts_written": len(parts)}
        committed = self._commit(base, Version(0, held, properties, schema.jsonValue(), total, {**kept_zones, **zones}, index))
        unstage(matched)
        return committed

    def _new_parts(self, batch: DataFrame, schema: T.StructType) -> DataFrame:
        missing = [f for f in schema.fields if f.name not in batch.columns]
        full = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else batch
        return full.select(self.part().alias("_part"))

    def keep_where(self, condition: Column, parts: Sequence[str] | None = None, least: object = None) -> int:
        """Delete rows that fail ``condition`` in the given parts (all if not given).

        Returns the number deleted. Only parts that lose rows are rewritten.
        ``least`` says that the condition is ``zone >= least`` or a null zone:
        parts wholly on one side are then kept or dropped without being read.
        """
        return self._attempt(lambda: self._keep_where(condition, parts, least))

    def _keep_where(self, condition: Column, parts: Sequence[str] | None, least: object) -> int:
        base = self.version()
        schema = self._columns(base)
        looked_at = list(base.parts) if parts is None else [p for p in parts if p in base.parts]
        dropped: dict[str, int] = {}
        if least is not None and self.zone is not None:
            for part in list(looked_at):
                rows, nulls, low, high = base.zones.get(part, (0, 1, None, None))
                if part not in base.zones or low is not None and low < least and (high >= least or nulls):
                    continue  # divided by the cutoff, or not known
                looked_at.remove(part)
                if low is not None and high < least:
                    dropped[part] = rows
        losing = {}
        if looked_at:
            counted = self._read(base.parts, looked_at, schema).where(~condition).groupBy(self.part().alias("_part")).count()
            losing = {r["_part"]: r["count"] for r in counted.collect()}
        self.last |= {"parts_read": len(looked_at), "parts_dropped": len(dropped)}
        if not losing and not dropped:
            return 0
        kept, zones = self._write(self._read(base.parts, sorted(losing), schema).where(condition), schema) if losing else ({}, {})
        carried = {p: f for p, f in base.parts.items() if p not in losing and p not in dropped}
        kept_zones = {p: z for p, z in base.zones.items() if p in carried}
        deleted = sum(losing.values()) + sum(dropped.values())
        held, left = {**carried, **kept}, base.rows - deleted
        self._commit(base, Version(0, held, base.properties, schema.jsonValue(), left, {**kept_zones, **zones}, base.index if held else None))
        return deleted

    # -- key index --------------------------------------------------------
    # Rows of (key, part, seq) in 2^bits buckets by the low bits of the key's
    # hash, once the table outgrows one bucket. The row with the greatest seq is
    # where the key was last written; a purge leaves the index as it is, so a
    # lookup may name a part without need but never misses one.

    def _index_schema(self, schema: T.StructType) -> T.StructType:
        return T.StructType([schema[self.key], T.StructField("_part", T.StringType()), T.StructField("_seq", T.LongType())])

    def _bucket(self, bits: int) -> Column:
        return F.xxhash64(self.key).bitwiseAND(F.lit((1 << bits) - 1))

    def _index_rows(self, index: dict, buckets, schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/data/{f}" for b in buckets for f in index["buckets"].get(str(b), [])]
        kind = self._index_schema(schema)
        return self.spark.read.schema(kind).parquet(*folders) if folders else empty_table(self.spark, kind)

    def _write_index(self, rows: DataFrame, bits: int) -> tuple[dict[str, list[str]], int]:
        run, seen = f"index-{uuid.uuid4().hex}", Observation()
        shaped = rows.withColumn("_bucket", self._bucket(bits)).hint("rebalance", F.col("_bucket"))
        shaped.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("_bucket").parquet(f"{self.path}/data/{run}")
        names = [n for n in paths.names(self.spark, f"{self.path}/data/{run}") if n.startswith("_bucket=")]
        return {n.removeprefix("_bucket="): [f"{run}/{n}"] for n in names}, observed(seen).get("rows", 0)

    def _bits(self, rows: int) -> int:
        return max(0, math.ceil(math.log2(max(1, rows) / self.index_rows)))

    def _index_all(self, parts: dict[str, list[str]], schema: T.StructType, total: int) -> dict | None:
        """The index of a table that has none yet; none is needed while one bucket would hold all keys."""
        if self.index_rows is None or total <= self.index_rows:
            return None
        bits = self._bits(total)
        rows = self._read(parts, parts, schema).select(self.key, self.part().alias("_part"), F.lit(0).cast("long").alias("_seq"))
        buckets, n = self._write_index(rows, bits)
        return {"bits": bits, "rows": n, "buckets": buckets}

    def _indexed(self, base: Version, batch: DataFrame) -> DataFrame:
        """_part of where the batch's keys were last written, read from their buckets alone."""
        bits = base.index["bits"]
        buckets = [r[0] for r in batch.select(self._bucket(bits)).distinct().collect()]
        seen = Observation()
        entries = self._index_rows(base.index, buckets, self._columns(base))
        entries = entries.observe(seen, F.count(F.lit(1)).alias("rows"))
        found = stage(last_wins(entries.join(batch.select(self.key), self.key, "left_semi"), self.key, ["_seq"]).select("_part").distinct(), "found")
        self.last |= {"index_rows_read": observed(seen).get("rows", 0), "index_buckets_read": len(buckets)}
        return found

    def _index_more(
        self, base: Version, matched: DataFrame, keys: DataFrame, parts: dict[str, list[str]], schema: T.StructType, total: int,
    ) -> dict:
        """The index with the keys of the batch that are new or have moved to another part.

        ``matched``: the keys that were there before, and their parts.
        """
        index, seq = base.index, base.number + 1
        located = self._read(parts, parts, schema).select(self.key, self.part().alias("_part")).join(keys, self.key, "left_semi")
        fresh = located.join(matched, [self.key, "_part"], "left_anti").withColumn("_seq", F.lit(seq).cast("long"))
        buckets, n = self._write_index(fresh, index["bits"])
        rows = index["rows"] + n
        joined = {b: index["buckets"].get(b, []) + buckets.get(b, []) for b in {*index["buckets"], *buckets}}
        # Bits follow the table, not the index, which also holds what was purged.
        bits = max(self._bits(total), index["bits"])
        crowded = list(joined) if bits > index["bits"] else [b for b, folders in joined.items() if len(folders) > INDEX_FOLDERS]
        if not crowded:
            return {"bits": bits, "rows": rows, "buckets": joined}
        entries = self._index_rows({"buckets": joined}, crowded, schema)
        rewritten, n = self._write_index(last_wins(entries, self.key, ["_seq"]), bits)
        if bits > index["bits"]:
            return {"bits": bits, "rows": n, "buckets": rewritten}
        return {"bits": bits, "rows": rows, "buckets": {**{b: f for b, f in joined.items() if b not in crowded}, **rewritten}}

    # -- snapshots --------------------------------------------------------
    def rotate(self, keep: int) -> list[int]:
        """Drop all but the newest ``keep`` versions; 0 keeps every one."""
        if self.group is not None:
            raise ValueError("tables of a group are rotated together")
        numbers = self.version_numbers()
        return self.drop_versions(numbers[:-keep] if keep > 0 else [])

    def drop_versions(self, old: list[int]) -> list[int]:
        """Delete these versions and the folders that no other one names."""
        if not old:
            return []
        needed = {f for n in self.stored_numbers() if n not in old for f in self.version(n).folders()}
        unused = {f for n in old for f in self.version(n).folders()} - needed
        for folder in sorted(unused):
            paths.delete(self.spark, f"{self.path}/data/{folder}")
        for number in old:
            paths.delete(self.spark, f"{self.path}/versions/{number:08d}.json")
        return old

    def vacuum(self, older_than_seconds: float = 7 * 86400) -> list[str]:
        """Delete folders of writes that never became a version; returns their names.

        Younger folders may belong to a write that is still under way.
        """
        live = set(self.version_numbers())
        limit = time.time() - older_than_seconds
        dead = [n for n in self.stored_numbers() if n not in live and paths.modified(self.spark, f"{self.path}/versions/{n:08d}.json") < limit]
        for number in dead:
            paths.delete(self.spark, f"{self.path}/versions/{number:08d}.json")
        named = {f.split("/")[0] for n in self.stored_numbers() for f in self.version(n).folders()}
        lost = [
            n for n in paths.names(self.spark, f"{self.path}/data")
            if n not in named and paths.modified(self.spark, f"{self.path}/data/{n}") < limit
        ]
        for run in lost:
            paths.delete(self.spark, f"{self.path}/data/{run}")
        return lost


class SnapshotGroup:
    """Tables whose versions become visible together.

    A commit is one small file that names a version of each table. Inside
    ``transaction`` the tables are written as usual; their new versions are read
    by the same transaction alone until its commit, and if it fails no table has
    changed. A write outside one is a commit of its own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.tables: dict[str, SnapshotTable] = {}
        self._open: dict[str, int] | None = None

    def add(self, table: SnapshotTable) -> None:
        self.tables[table.name] = table

    def commit_numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in paths.names(self.spark, f"{self.path}/commits") if n.endswith(".json") and not n.startswith(".")]

    def commit(self, number: int | None = None) -> dict[str, int]:
        """Version of each table in a commit (the newest if not given)."""
        if number is None:
            number = max(self.commit_numbers(), default=None)
        return {} if number is None else json.loads(paths.read_text(self.spark, f"{self.path}/commits/{number:08d}.json"))

    def current(self, name: str) -> int | None:
        if self._open and name in self._open:
            return self._open[name]
        return self.commit().get(name)

    def named(self, name: str) -> list[int]:
        """Versions of a table that some commit names."""
        return sorted({v for n in self.commit_numbers() if (v := self.commit(n).get(name)) is not None})

    def _publish(self, base: int, versions: dict[str, int]) -> None:
        body = json.dumps({**self.commit(), **versions}, sort_keys=True)
        paths.create_text(self.spark, f"{self.path}/commits/{base + 1:08d}.json", body)

    def record(self, name: str, number: int) -> None:
        if self._open is None:
            self._publish(max(self.commit_numbers(), default=0), {name: number})
        else:
            self._open[name] = number

    @contextmanager
    def transaction(self) -> Iterator[None]:
        if self._open is not None:
            raise ValueError("a transaction is open already")
        base, self._open = max(self.commit_numbers(), default=0), {}
        try:
            yield
            # Fails if another writer committed since; nothing is changed then.
            if self._open:
                self._publish(base, self._open)
        finally:
            self._open = None

    def rotate(self, keep: int) -> list[int]:
        """Drop all but the newest ``keep`` commits and what only they name; 0 keeps every one."""
        numbers = self.commit_numbers()
        old = numbers[:-keep] if keep > 0 else []
        kept = [self.commit(n) for n in numbers if n not in old]
        for name, table in self.tables.items():
            needed = {c[name] for c in kept if name in c}
            gone = {v for n in old if (v := self.commit(n).get(name)) is not None} - needed
            table.drop_versions(sorted(gone))
        for number in old:
            paths.delete(self.spark, f"{self.path}/commits/{number:08d}.json")
        return old

    def vacuum(self, older_than_seconds: float = 7 * 86400) -> dict[str, list[str]]:
        return {name: table.vacuum(older_than_seconds) for name, table in self.tables.items()}
