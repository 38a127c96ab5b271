"""Named tables over Parquet folders.

Every full refresh writes a new version folder and then points the table at it,
so readers see the old rows or the new rows and never a mixture.

A table may be cut into buckets by a hash of keys, one folder each. An update by these keys
reads and replaces only the buckets that its keys fall into; each of them is replaced as a
whole once the new rows are complete, one bucket after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.operators.sampling import top_n
from corpusgraph.sources import files
from corpusgraph.sources.scratch import materialize

_REQUIRED = "corpusgraph.required"
_BUCKETED = "corpusgraph.buckets"
_BUCKET = "_bucket"
BUCKETS = 64


class ReadOnlyError(RuntimeError):
    """A write was asked of a namespace attached for reading."""


@dataclass(frozen=True)
class WriteStats:
    """What a write stored."""

    table: str
    rows: int
    path: str


def from_records(
    spark: SparkSession, records: Iterable[dict | Sequence], schema: T.StructType | str
) -> DataFrame:
    """A small frame from records on the driver; absent fields become NULL."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    rows = [
        tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r)
        for r in records
    ]
    return spark.createDataFrame(rows, schema)


class Lake:
    """One namespace of tables, read-write or read-only."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        location: str | None = None,
        read_only: bool = False,
    ) -> None:
        self.spark = spark
        self.database = database
        self.read_only = read_only
        if location and not spark.catalog.databaseExists(database):
            spark.sql(f"CREATE DATABASE `{database}` LOCATION '{location}'")
        self.location = spark.catalog.getDatabase(database).locationUri

    def qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def use(self) -> None:
        """Make this the namespace of unqualified names in SQL."""
        self.spark.catalog.setCurrentDatabase(self.database)

    # Reading

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise LookupError(f"no table {self.database}.{name}")
        return self.spark.table(self.qualified(name)).drop(_BUCKET)

    def tables(self) -> list[str]:
        found = self.spark.catalog.listTables(self.database)
        return sorted(t.name for t in found if not t.isTemporary)

    def columns(self, name: str) -> list[str]:
        return self.read(name).columns

    # Writing

    def write(self, df: DataFrame, name: str) -> WriteStats:
        """Replace all rows. Columns are matched by name and new ones are added;
        stored columns that the frame lacks are filled with NULL."""
        self._check_writable()
        if not self.exists(name):
            return self._create(df, name)
        stored = self.read(name).schema
        for field in df.schema:
            if field.name not in stored.fieldNames():
                self.add_column(name, field.name, field.dataType)
        layout = self._buckets(name)
        if layout:
            required = self._required(name)
            stats = self.write_bucketed(self._conform(df, name), name, *layout)
            self._require(name, required)
            return stats
        stats = self._store(self._conform(df, name), name)
        self._point(name, stats.path)
        return stats

    def write_bucketed(
        self, df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS
    ) -> WriteStats:
        """Create a table, or replace one with all that was declared of it, in buckets by
        a hash of keys. Give so many that a bucket is a part that one update may rewrite."""
        self._check_writable()
        stats = self._store(_with_bucket(df, keys, buckets), name, bucketed=True)
        self.drop(name)
        self._register_bucketed(name, df.schema, stats.path, f"{buckets}:{','.join(keys)}")
        return stats

    def append(self, df: DataFrame, name: str) -> WriteStats:
        """Add rows, matched by name; stored columns the frame lacks become NULL."""
        self._check_writable()
        seen = Observation()
        conformed = self._conform(df, name)
        layout = self._buckets(name)
        if layout:
            conformed = _with_bucket(conformed, *layout)
        rows = conformed.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.insertInto(self.qualified(name))
        self.spark.catalog.refreshTable(self.qualified(name))
        return WriteStats(name, int(seen.get["rows"]), self._folder(name))

    def add_column(
        self, name: str, column: str, data_type: T.DataType | str = "string"
    ) -> bool:
        """Add a column unless it is there; tells whether it was added."""
        self._check_writable()
        if column in self.columns(name):
            return False
        ddl = data_type if isinstance(data_type, str) else data_type.simpleString()
        self.spark.sql(
            f"ALTER TABLE {self.qualified(name)} ADD COLUMNS (`{column}` {ddl})"
        )
        return True

    def ensure_table(self, name: str, schema: T.StructType) -> bool:
        """Create an empty table unless it is there, or add the columns it lacks.

        Columns declared not nullable are checked on every later write.
        """
        self._check_writable()
        if self.exists(name):
            for field in schema:
                self.add_column(name, field.name, field.dataType)
            return False
        self._register(name, schema, f"{self.location}/{name}/v-{uuid.uuid4().hex}")
        self._require(name, [f.name for f in schema if not f.nullable])
        return True

    def update_by_key(
        self,
        name: str,
        updates: DataFrame,
        keys: Sequence[str],
        columns: Sequence[str],
        order_by: str | None = None,
    ) -> WriteStats:
        """Set ``columns`` on every stored row whose keys match.

        Several updates of one key leave the one that is last by ``order_by``, NULL
        first; of equal ones the last by the values as JSON. Without ``order_by``
        several updates of one key are refused. The pick is an aggregate, so a key with
        many updates is reduced before the shuffle, and the join keeps the stored
        table's rows where they are when the updates are small. Of a table in buckets by
        these keys only the buckets with updates are read and written.
        """
        self._check_writable()
        new = F.struct(*columns)
        if order_by:
            pick = F.max_by(new, F.struct(order_by, F.to_json(new)))
        else:
            complaint = F.lit(f"{name}: several updates of one key need an order")
            pick = F.when(F.count(F.lit(1)) > 1, F.raise_error(complaint)).otherwise(F.first(new))
        newest = updates.groupBy(*keys).agg(pick.alias("_new"))
        layout = self._buckets(name)
        in_buckets = layout is not None and list(layout[0]) == list(keys)
        stored = self.read(name)
        if in_buckets:
            kinds = {k: F.col(k).cast(stored.schema[k].dataType) for k in keys}
            newest = materialize(_with_bucket(newest.withColumns(kinds), *layout), "updates")
            # At most as many numbers as there are buckets.
            touched = [r[0] for r in newest.select(_BUCKET).distinct().collect()]
            stored = self.spark.table(self.qualified(name)).where(F.col(_BUCKET).isin(touched))
            newest = newest.drop(_BUCKET)
        joined = stored.join(newest, list(keys), "left")
        hit = F.col("_new").isNotNull()
        changed = joined.withColumns(
            {c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in columns}
        ).drop("_new")
        if not in_buckets:
            return self.write(changed, name)
        conformed = _with_bucket(self._conform(changed, name), *layout)
        seen = Observation()
        counted = conformed.observe(seen, F.count(F.lit(1)).alias("rows"))
        # The table's own option makes this replace the buckets that it writes, no others.
        counted.write.insertInto(self.qualified(name), overwrite=True)
        self.spark.catalog.refreshTable(self.qualified(name))
        return WriteStats(name, int(seen.get["rows"]), self._folder(name))

    def pull(
        self, source: Lake, name: str, limit: int | None = None, key: str | None = None
    ) -> int:
        """Copy a table from another namespace, replacing the one here.

        A limit of 0 or None copies everything. With a unique ``key`` a limit keeps the
        first rows by it, else any rows. The copy is complete before the table here
        changes: a failure leaves it as it was, and a table may be pulled onto itself.
        With equal columns the change is one move of the location.
        """
        self._check_writable()
        rows = source.read(name)
        if limit:
            rows = top_n(rows, key, limit) if key else rows.limit(limit)
        stats = self._store(rows, name)
        if self.exists(name) and self._same_form(name, rows.schema):
            self._point(name, stats.path)
        else:
            self.drop(name)
            self._register(name, rows.schema, stats.path)
        return stats.rows

    def export(self, name: str, fmt: str, path: str) -> files.FileStats:
        return files.export(self.read(name), path, fmt)

    def drop(self, name: str) -> None:
        """Forget a table; its folders stay until the namespace is cleaned."""
        self._check_writable()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")

    def clean(self, name: str) -> int:
        """Delete the versions of a table that are no longer its current one, and tell
        how many. Readers of an old version must be done by then."""
        self._check_writable()
        current = self._folder(name).rstrip("/").rsplit("/", 1)[-1]
        old = [p for p in files.subfolders(self.spark, f"{self.location}/{name}")
               if not p.endswith(f"/{current}")]
        for path in old:
            files.delete_folder(self.spark, path)
        return len(old)

    # Internals

    def _check_writable(self) -> None:
        if self.read_only:
            raise ReadOnlyError(f"namespace {self.database} is attached read-only")

    def _create(self, df: DataFrame, name: str) -> WriteStats:
        stats = self._store(df, name)
        self._register(name, df.schema, stats.path)
        return stats

    def _store(self, df: DataFrame, name: str, bucketed: bool = False) -> WriteStats:
        """Write a new version folder, counting the rows on the way."""
        path = f"{self.location}/{name}/v-{uuid.uuid4().hex}"
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(*[_BUCKET] * bucketed).parquet(path)
        return WriteStats(name, int(seen.get["rows"]), path)

    def _register(self, name: str, schema: T.StructType, path: str) -> None:
        loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.spark.catalog.createTable(
            self.qualified(name), path=path, source="parquet", schema=loose
        )

    def _register_bucketed(
        self, name: str, schema: T.StructType, path: str, layout: str
    ) -> None:
        table = self.qualified(name)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE {table} ({fields}, {_BUCKET} int) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({_BUCKET}) "
            f"LOCATION '{path}' TBLPROPERTIES ('{_BUCKETED}' = '{layout}')"
        )
        self.spark.catalog.recoverPartitions(table)

    def _buckets(self, name: str) -> tuple[list[str], int] | None:
        """Keys and number of the buckets of a table that has them."""
        value = self._property(name, _BUCKETED)
        if not value:
            return None
        number, keys = value.split(":", 1)
        return keys.split(","), int(number)

    def _require(self, name: str, columns: Sequence[str]) -> None:
        if columns:
            self.spark.sql(
                f"ALTER TABLE {self.qualified(name)} "
                f"SET TBLPROPERTIES ('{_REQUIRED}' = '{','.join(columns)}')"
            )

    def _point(self, name: str, path: str) -> None:
        table = self.qualified(name)
        self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(table)

    def _folder(self, name: str) -> str:
        details = self.spark.sql(f"DESCRIBE FORMATTED {self.qualified(name)}")
        found = details.where("col_name = 'Location'").select("data_type").first()
        return found[0]

    def _same_form(self, name: str, schema: T.StructType) -> bool:
        """Whether a table has these columns, requires none of them and has no buckets."""
        stored = self.read(name).schema.simpleString()
        plain = not self._required(name) and not self._buckets(name)
        return stored == schema.simpleString() and plain

    def _required(self, name: str) -> list[str]:
        value = self._property(name, _REQUIRED)
        return value.split(",") if value else []

    def _property(self, name: str, key: str) -> str | None:
        listed = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}")
        value = listed.where(F.col("key") == key).select("value").first()
        return value[0] if value else None

    def _conform(self, df: DataFrame, name: str) -> DataFrame:
        """The frame in the stored column order and types."""
        required = self._required(name)
        given = set(df.columns)

        def column(field: T.StructField) -> Column:
            if field.name not in given:
                value = F.lit(None)
            else:
                value = F.col(f"`{field.name}`")
            if field.name in required:
                complaint = F.raise_error(F.lit(f"{name}.{field.name} must not be NULL"))
                value = F.coalesce(value, complaint.cast(field.dataType))
            return value.cast(field.dataType).alias(field.name)

        return df.select(*[column(f) for f in self.read(name).schema])


def _hash(keys: Sequence[str], buckets: int) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.lit(buckets)


def _with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(*_hash(keys, buckets)).cast("int"))


def attach(
    spark: SparkSession,
    local: tuple[str, str],
    remote: tuple[str, str] | None = None,
) -> tuple[Lake, Lake | None]:
    """Attach a read-write and, optionally, a read-only namespace.

    Each is given as (database name, folder). The local one becomes the default
    of unqualified names.
    """
    here = Lake(spark, *local)
    there = Lake(spark, *remote, read_only=True) if remote else None
    here.use()
    return here, there
