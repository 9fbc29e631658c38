"""Tables under one folder, changed by whole versions.

New rows go to a folder of their own, ``data/<table>/batch=<id>``; then one small file, ``versions/<number>``, names the batches
of every table. That file is the only switch: until it is there readers see the version before, a write that fails leaves
nothing that a reader finds, and a table may be replaced from itself. A second writer of the same number is refused.

Tables that grow by their new rows only are *keyed*: distinct rows with their number of copies, bucketed and sorted by a
128-bit digest of the row. An append meets them in an anti-join on the digest that leaves the stored rows where they lie; rows
of equal digest are compared column by column, nulls being equal. A row repeated in a third of a table is one stored row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.sets import as_stored, distinct_with_copies, require_same_columns
from kpiloom.session import materialized, remove_folder
from kpiloom.sources.reports import exists

COPIES, DIGEST = "__copies", ("__digest_1", "__digest_2")


@dataclass(frozen=True)
class Stored:
    """One table of a version: its columns, and the batches that hold its rows."""

    schema: str
    batches: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    buckets: int = 0  # 0: not keyed

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Version:
    number: int
    tables: Mapping[str, Stored]


def digests(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row that tell where its nulls are."""
    cells = [F.col(f"`{c}`") for c in columns]
    nulls = [c.isNull() for c in cells]
    return [F.xxhash64(F.lit(seed), *cells, *nulls).alias(name) for seed, name in enumerate(DIGEST)]


def same_row(a: str, b: str, columns: list[str]) -> Column:
    """Whether the rows aliased a and b are equal. Kept whole, so that a join on digests does not become one on all columns."""
    equal = [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns]
    return F.forall(F.array(*equal), lambda x: x)


class VersionedTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[Version]:
        """All committed versions, oldest first."""
        place = f"{self.folder}/versions"
        if not exists(self.spark, place):
            return []
        # one short line per version
        lines = self.spark.read.option("recursiveFileLookup", True).text(place).collect()
        found = [json.loads(r.value) for r in lines]
        return sorted((Version(v["number"], {n: Stored(t["schema"], tuple(t["batches"]), tuple(t["partition_by"]), t["buckets"]) for n, t in v["tables"].items()}) for v in found), key=lambda v: v.number)

    def current(self) -> Version:
        return (self.versions() or [Version(0, {})])[-1]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version, by default the last one. What is read stays the same whatever is written later."""
        found = self.current() if version is None else next((v for v in self.versions() if v.number == version), Version(0, {}))
        if name not in found.tables:
            raise KeyError(f"no table {name!r} in {self.folder}, version {found.number}")
        return self._rows(name, found.tables[name])

    def replace(self, tables: Mapping[str, DataFrame], partition_by: Mapping[str, list[str]] | None = None, keyed: bool = False) -> Version:
        """Create or replace the tables, all in one version; other tables stay as they are."""
        before = self.current()
        made = {}
        for name, rows in tables.items():
            stored = Stored(rows.schema.json(), (uuid.uuid4().hex,), tuple((partition_by or {}).get(name, ())), self._buckets() if keyed else 0)
            if keyed:
                self._write_keyed(name, stored, distinct_with_copies(rows, COPIES))
            else:
                writer = rows.write
                (writer.partitionBy(*stored.partition_by) if stored.partition_by else writer).parquet(self._place(name, stored.batches[0]))
            made[name] = stored
        return self._commit(before, made)

    def append_new(self, name: str, rows: DataFrame) -> Version:
        """Append the distinct rows that the table lacks; a table that is not there is created with its repeats.

        Rows take the stored column types; other columns, or values that those types cannot hold, stop the run before anything
        is written. Of a table that was stored without digests the rows are stored again, once.
        """
        before = self.current()
        if name not in before.tables:
            return self.replace({name: rows}, keyed=True)
        stored = before.tables[name]
        rows = as_stored(rows, self._rows(name, stored))
        if not stored.buckets:
            plain, stored = stored, replace(stored, batches=(uuid.uuid4().hex,), partition_by=(), buckets=self._buckets())
            self._write_keyed(name, stored, distinct_with_copies(self._rows(name, plain), COPIES))
        with self._known(name, stored) as known:
            fresh = self._unknown(rows, known, stored.columns.names).withColumn(COPIES, F.lit(1).cast("long"))
            batch = uuid.uuid4().hex
            self._insert(known, name, stored, fresh, batch)
        return self._commit(before, {name: replace(stored, batches=(*stored.batches, batch))})

    def rows_not_in(self, name: str, rows: DataFrame) -> DataFrame:
        """Distinct rows that the keyed table lacks; nulls compare equal. They are written once and read back."""
        stored = self.current().tables[name]
        with self._known(name, stored) as known:
            return materialized(self._unknown(rows, known, stored.columns.names), "new-rows")

    def count(self, name: str) -> int:
        stored = self.current().tables[name]
        if not stored.buckets:
            return self._rows(name, stored).count()
        held = self.spark.read.schema(f"{COPIES} bigint").parquet(*self._places(name, stored))
        return held.agg(F.coalesce(F.sum(COPIES), F.lit(0))).first()[0]

    def forget(self, keep: int = 1) -> list[int]:
        """Delete all but the last versions and the batches that only they hold; returns their numbers. Not while others read or write."""
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        held = {(n, b) for v in kept for n, t in v.tables.items() for b in t.batches}
        for v in old:
            remove_folder(self.spark, f"{self.folder}/versions/{v.number:010d}")
            for name, batch in {(n, b) for n, t in v.tables.items() for b in t.batches} - held:
                remove_folder(self.spark, self._place(name, batch))
        return [v.number for v in old]

    def _place(self, name: str, batch: str) -> str:
        return f"{self.folder}/data/{name}/batch={batch}"

    def _places(self, name: str, stored: Stored) -> list[str]:
        return [self._place(name, b) for b in stored.batches]

    def _buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _rows(self, name: str, stored: Stored) -> DataFrame:
        columns = stored.columns
        if not stored.buckets:
            reader = self.spark.read.schema(columns)
            if stored.partition_by:
                reader = reader.option("basePath", self._place(name, stored.batches[0]))
            return reader.parquet(*self._places(name, stored)).select(*[F.col(f"`{c}`") for c in columns.names])
        held = self.spark.read.schema(T.StructType([*columns.fields, T.StructField(COPIES, T.LongType())])).parquet(*self._places(name, stored))
        return held.select(*[F.col(f"`{c}`") for c in columns.names], F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias("__copy")).drop("__copy")

    def _commit(self, before: Version, made: Mapping[str, Stored]) -> Version:
        after = Version(before.number + 1, {**before.tables, **made})
        line = json.dumps({"number": after.number, "tables": {n: {"schema": t.schema, "batches": t.batches, "partition_by": t.partition_by, "buckets": t.buckets} for n, t in after.tables.items()}})
        self.spark.range(1, numPartitions=1).select(F.lit(line).alias("value")).write.text(f"{self.folder}/versions/{after.number:010d}")
        return after

    @contextmanager
    def _known(self, name: str, stored: Stored) -> Iterator[str]:
        """The keyed table's batches under a name that the planner knows the buckets of."""
        known = f"kpiloom_{uuid.uuid4().hex}"
        fields = [*stored.columns.fields, T.StructField(COPIES, T.LongType()), *(T.StructField(d, T.LongType()) for d in DIGEST), T.StructField("__batch", T.StringType())]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = ", ".join(DIGEST)
        place = f"{self.folder}/data/{name}"
        self.spark.sql(f"CREATE TABLE {known} ({listed}) USING parquet PARTITIONED BY (__batch) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {stored.buckets} BUCKETS LOCATION '{place}'")
        try:
            if stored.batches:
                parts = " ".join(f"PARTITION (__batch = '{b}') LOCATION '{self._place(name, b)}'" for b in stored.batches)
                self.spark.sql(f"ALTER TABLE {known} ADD {parts}")
            yield known
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {known}")

    def _unknown(self, rows: DataFrame, known: str, columns: list[str]) -> DataFrame:
        """Distinct rows that the open table lacks."""
        require_same_columns(rows.columns, columns)
        new = rows.select(*[F.col(f"`{c}`") for c in columns]).dropDuplicates()
        keyed = new.select("*", *digests(columns)).alias("new")
        held = self.spark.table(known).alias("held").hint("merge")
        met = same_row("new", "held", columns)
        for d in DIGEST:
            met = (F.col(f"new.{d}") == F.col(f"held.{d}")) & met
        return keyed.join(held, met, "left_anti").select(*[F.col(f"`{c}`") for c in columns])

    def _insert(self, known: str, name: str, stored: Stored, rows: DataFrame, batch: str) -> None:
        columns = stored.columns.names
        self.spark.sql(f"ALTER TABLE {known} ADD PARTITION (__batch = '{batch}') LOCATION '{self._place(name, batch)}'")
        wide = rows.select(*[F.col(f"`{c}`") for c in columns], COPIES, *digests(columns), F.lit(batch).alias("__batch"))
        wide.repartition(stored.buckets, *DIGEST).sortWithinPartitions(*DIGEST).write.insertInto(known)

    def _write_keyed(self, name: str, stored: Stored, distinct: DataFrame) -> None:
        with self._known(name, replace(stored, batches=())) as known:
            self._insert(known, name, stored, distinct, stored.batches[0])
