"""The keyed, partitioned lake table (K1-K5, K7, K8).

Layout and commit protocol
--------------------------
* Data: ``<path>/<version>/<col>=<value>/_commit=<version>/part-*.parquet``
  (hive-style, K7).  The last level, ``_commit``, names the commit that wrote
  the files; it is a partition column of the catalog tables, hidden by the view.
* Every commit writes a **new version folder** — a table is never rewritten in
  place, because a plan that reads a folder cannot safely overwrite it.
* The new version is registered as its own external catalog table
  ``<db>.<name>__<version>``; its new partitions are found in the new folder
  (``RECOVER PARTITIONS``) and every partition it keeps is attached at its old
  location (``ADD PARTITION ... LOCATION``), so kept files are never copied.
* Appends (K4) keep every existing (partition, commit) folder and only add
  their own: the cost is the size of the new rows.  Upserts and deletes are
  copy-on-write per partition: the partitions their input touches are
  rewritten (which also compacts the commit folders appends left there), the
  others are kept.
* The view ``<db>.<name>`` is then switched to the new version (K8).  Readers
  that resolved the view before the switch keep reading the old, complete
  version; new readers see the new one.  Old version folders stay.
* Marks (how far a log or a list of events has been worked off) are properties
  of that view: they change in the same switch as the rows they stand for, so
  work repeated after a crash finds either both or neither.

Partition scoping requires the partition columns to be part of the record
key (a key then lives in exactly one partition); otherwise commits rewrite
the whole table.  The driver holds the list of partitions and their locations,
as the catalog calls need it; it grows with the number of partitions.  With
``buckets`` the table is partitioned by a hash of the key instead: then there
are at most that many partitions however many devices write, and upserts and
deletes read only the buckets they touch.
"""

from __future__ import annotations

import time
import urllib.parse
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType, StructType

from ..operators.keyed import delete_keys, latest_per_key
from ..operators.staging import stage

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_CURRENT = "telemetra.current"
_MARK = "telemetra.mark."
COMMIT_COL = "_commit"
BUCKET_COL = "_bucket"
#: Kept partitions are attached this many per ALTER TABLE statement.
ADD_PARTITION_CHUNK = 500


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class LakeTable:
    """A keyed table with one row per ``keys`` (for keyed writes), partitioned
    by ``partition_by``, or by ``buckets`` hash buckets of ``bucket_by`` (some of
    the keys; by default all of them, which spreads a hot device, too)."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        name: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        database: str = "telemetra",
        buckets: int | None = None,
        bucket_by: Sequence[str] = (),
    ):
        if buckets is not None and (buckets < 1 or partition_by or not set(bucket_by) <= set(keys)):
            raise ValueError("buckets (at least one) are made of keys and take the place of partition columns")
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = name
        self.keys = list(keys)
        self.partition_by = list(partition_by)
        self.database = database
        self.buckets = buckets
        self.bucket_by = list(bucket_by or keys)

    # --- catalog ------------------------------------------------------------------

    @property
    def view(self) -> str:
        return f"{self.database}.{self.name}"

    def _version_table(self, version: str) -> str:
        return f"{self.database}.{self.name}__{version}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.view)

    def _properties(self) -> dict[str, str]:
        if not self.exists():
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.view}").collect()}

    def current_version(self) -> str | None:
        return self._properties().get(_CURRENT)

    def marks(self) -> dict[str, int]:
        """The marks of the current version."""
        return {k.removeprefix(_MARK): int(v) for k, v in self._properties().items() if k.startswith(_MARK)}

    def mark(self, name: str, default: int = -1) -> int:
        return self.marks().get(name, default)

    def read(self) -> DataFrame:
        """Current snapshot (S5 through the catalog; partition pruning applies)."""
        return self.spark.table(self.view)

    def read_marked(self) -> tuple[DataFrame, dict[str, int]]:
        """Rows and marks of one version, whatever is committed meanwhile."""
        properties = self._properties()
        marks = {k.removeprefix(_MARK): int(v) for k, v in properties.items() if k.startswith(_MARK)}
        return self.read_snapshot(properties[_CURRENT]), marks

    def snapshot_location(self, version: str | None = None) -> str:
        version = version or self.current_version()
        return f"{self.path}/{version}"

    # --- partitions -----------------------------------------------------------------

    def _partition_scoped(self) -> bool:
        return self.buckets is not None or bool(self.partition_by) and set(self.partition_by) <= set(self.keys)

    def _bucket(self, stored: StructType) -> Column:
        """The bucket of a row by its key in the ``stored`` types; a NULL key has one like any other."""
        return F.pmod(F.xxhash64(*[F.col(c).cast(stored[c].dataType) for c in self.bucket_by]), F.lit(self.buckets)).cast("int")

    def _stored(self, df: DataFrame) -> DataFrame:
        """``df`` as the table stores it: '' in a partition column is NULL there."""
        texts = [c for c in self.partition_by if dict(df.dtypes)[c] == "string"]
        return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df

    @property
    def _levels(self) -> list[str]:
        """Partition columns of the catalog tables: the user's or the bucket, then the commit."""
        return [*self._own_levels, COMMIT_COL]

    @property
    def _own_levels(self) -> list[str]:
        return self.partition_by if self.buckets is None else [BUCKET_COL]

    def _spec(self, vals: tuple) -> str:
        return ", ".join(f"{c}={_sql_literal(v)}" for c, v in zip(self._levels, vals))

    def _partitions_of(self, table: str) -> list[tuple[tuple, str]]:
        """(values, escaped path spec) of every partition registered for ``table``."""
        out = []
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            vals = []
            for part in spec.split("/"):
                _, _, raw = part.partition("=")
                vals.append(None if raw == _NULL_PARTITION else urllib.parse.unquote(raw))
            out.append((tuple(vals), spec))
        return out

    def _locations(self, version: str) -> dict[tuple, str]:
        """Partition values -> location in ``version``: below the folder of the
        commit that wrote the partition, which is its last partition value."""
        parts = self._partitions_of(self._version_table(version))
        return {vals: f"{self.path}/{vals[-1]}/{spec}" for vals, spec in parts}

    # --- commit ---------------------------------------------------------------------

    def _columns(self, schema: StructType) -> list:
        fields = [f for f in schema.fields if f.name not in (*self.partition_by, COMMIT_COL, BUCKET_COL)]
        return fields + [schema[c] for c in self.partition_by]

    def _ddl(self, schema: StructType) -> str:
        cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in self._columns(schema)]
        bucket = [f"`{BUCKET_COL}` int"] if self.buckets is not None else []
        return ", ".join([*cols, *bucket, f"`{COMMIT_COL}` string"])

    def _commit(self, rows: DataFrame, touched: list[tuple] | None, append: bool = False, base: str | None = None, marks: Mapping[str, int] | None = None) -> str:
        """Write ``rows`` as a new version; fail if another commit followed ``base``.

        ``marks`` replace marks of the same name; the others stay as they are.

        ``append``: every existing partition is kept and ``rows`` are added.
        Otherwise ``rows`` are the full content of the ``touched`` partitions
        (``None``: of the whole table) and the other partitions are kept.
        """
        version = f"v{time.time_ns()}"
        location = f"{self.path}/{version}"
        out = self._stored(rows).withColumn(COMMIT_COL, F.lit(version))
        if self.buckets is not None:
            out = out.withColumn(BUCKET_COL, self._bucket(rows.schema))
        if self._own_levels:
            # one file per partition, several for one that is large
            out = out.hint("rebalance", *self._own_levels)
        out.write.mode("errorifexists").partitionBy(*self._levels).parquet(location)

        previous = self.current_version()
        if base is not None and previous != base:
            raise RuntimeError(f"{self.view}: planned on {base}, but {previous} has been committed since")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.path}/_catalog'")
        table = self._version_table(version)
        self.spark.sql(
            f"CREATE TABLE {table} ({self._ddl(rows.schema)}) USING parquet "
            f"PARTITIONED BY ({', '.join(self._levels)}) LOCATION '{location}'"
        )
        self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        if previous is not None and (append or touched is not None):
            old = self._locations(previous)
            if append:
                keep = old
            else:
                touched_set = set(touched)
                keep = {vals: loc for vals, loc in old.items() if vals[:-1] not in touched_set}
            items = list(keep.items())
            for i in range(0, len(items), ADD_PARTITION_CHUNK):
                adds = " ".join(
                    f"PARTITION ({self._spec(v)}) LOCATION '{loc}'" for v, loc in items[i : i + ADD_PARTITION_CHUNK]
                )
                self.spark.sql(f"ALTER TABLE {table} ADD {adds}")
        visible = ", ".join(f"`{f.name}`" for f in self._columns(rows.schema))
        properties = {_CURRENT: version} | {f"{_MARK}{k}": str(v) for k, v in (self.marks() | dict(marks or {})).items()}
        listed = ", ".join(f"{_sql_literal(k)}={_sql_literal(v)}" for k, v in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} TBLPROPERTIES ({listed}) AS SELECT {visible} FROM {table}")
        return version

    def read_snapshot(self, version: str | None = None) -> DataFrame:
        """The whole table as of one version, whichever commits wrote its files."""
        visible = [f.name for f in self._columns(self.read().schema)]
        table = self.spark.table(self._version_table(version or self.current_version()))
        return table.select(*[c for c in visible if c in table.columns])

    def _scoped(self, incoming: DataFrame) -> tuple[DataFrame, list[tuple] | None]:
        """(current rows of the partitions ``incoming`` touches, touched list or None).

        Touched buckets, at most ``buckets`` numbers, become a filter on the
        partition column.  Other partitions are found by a semi-join with the
        staged distinct partition texts, so no list of values enters the plan;
        it is a plain equality ('' and NULL are one partition), which lets the
        scan prune its partitions by the staged side.
        """
        if not self._partition_scoped():
            return self.read(), None
        if self.buckets is not None:
            table = self.spark.table(self._version_table(self.current_version()))
            found = sorted(r[0] for r in incoming.select(self._bucket(table.schema)).distinct().collect())
            scoped = table.where(F.col(BUCKET_COL).isin(found)).select(*[f.name for f in self._columns(table.schema)])
            return scoped, [(str(b),) for b in found]
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.partition_by]
        names = [f"_t_{c}" for c in self.partition_by]
        touched = stage(incoming.select(*[t.alias(n) for t, n in zip(text, names)]).distinct(), "touched")
        # partitions are pruned only by a side that has a filter; this one keeps every row
        scoped = self.read().join(touched.where(F.length(names[0]) >= 0), [t == F.col(n) for t, n in zip(text, names)], "left_semi")
        return scoped, [tuple(v or None for v in r) for r in touched.collect()]

    def _aligned(self, df: DataFrame) -> DataFrame:
        """``df`` with the stored columns in their stored types (kept files
        have no others), then its new ones.

        Columns ``df`` lacks are NULL.  A value that the stored type cannot
        hold fails the commit, and so does a fractional column for a stored
        integral one, which a cast would truncate.
        """
        fields = self._columns(self.read().schema)
        given = {f.name: f.dataType for f in df.schema.fields}
        for f in fields:
            if isinstance(f.dataType, IntegralType) and isinstance(given.get(f.name), FractionalType):
                raise ValueError(f"{f.name}: {given[f.name].simpleString()} rows do not fit the stored {f.dataType.simpleString()}")
        names = {f.name for f in fields}
        cols = [(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
        return df.select(*cols, *[F.col(c) for c in df.columns if c not in names])

    # --- operations -----------------------------------------------------------------

    def overwrite(self, df: DataFrame, order_by: Sequence[str | Column], marks: Mapping[str, int] | None = None) -> str:
        """K1: replace the table with ``df``, one row per key (latest by ``order_by``)."""
        return self._commit(latest_per_key(df, self.keys, order_by), None, marks=marks)

    def insert_overwrite(self, df: DataFrame, marks: Mapping[str, int] | None = None) -> str:
        """K3: replace the table with ``df`` as is (no key dedup)."""
        return self._commit(df, None, marks=marks)

    def insert_append(self, df: DataFrame, marks: Mapping[str, int] | None = None) -> str:
        """K4: add ``df``'s rows as they are (duplicates of existing keys included)."""
        if not self.exists():
            return self._commit(df, None, marks=marks)
        # existing rows and files are kept as they are; only ``df`` is written;
        # old files read columns that only ``df`` has as NULL
        base = self.current_version()
        return self._commit(self._aligned(self._stored(df)), None, append=True, base=base, marks=marks)

    def upsert(self, df: DataFrame, order_by: Sequence[str | Column], marks: Mapping[str, int] | None = None) -> str:
        """K2: key match -> whole row replaced by the latest source row, else insert."""
        if not self.exists():
            return self.overwrite(df, order_by, marks)
        base = self.current_version()
        # the latest source rows are evaluated once: for the touched
        # partitions, the join and the rows written
        latest = stage(latest_per_key(self._stored(df), self.keys, order_by), "upsert-rows")
        current, touched = self._scoped(latest)
        latest = self._aligned(latest)
        kept = delete_keys(current, latest.select(*self.keys), self.keys, distinct=False)
        return self._commit(kept.unionByName(latest, allowMissingColumns=True), touched, base=base, marks=marks)

    def delete(self, rows: DataFrame, marks: Mapping[str, int] | None = None) -> str:
        """K5: remove every row whose key appears in ``rows`` (NULL keys match NULL)."""
        # the key set is written once: it serves the touched-partition list and
        # the join, and the join is planned knowing its real size
        base = self.current_version()
        keys = stage(self._stored(rows.select(*self.keys)).dropDuplicates(), "delete-keys")
        current, touched = self._scoped(keys)
        return self._commit(delete_keys(current, keys, self.keys, distinct=False), touched, base=base, marks=marks)

    def register_as(self, qualified_name: str) -> str:
        """K8: expose the table under another catalog name, which follows its commits."""
        visible = ", ".join(f"`{f.name}`" for f in self._columns(self.read().schema))
        self.spark.sql(f"CREATE OR REPLACE VIEW {qualified_name} AS SELECT {visible} FROM {self.view}")
        return qualified_name
