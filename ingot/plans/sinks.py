"""Tables of the lakehouse and the ways rows reach them.

Three databases (bronze, silver, gold) of Parquet tables under one root
folder.  Rows reach a table in parts.  A part is a folder that one job wrote;
it belongs to the table from the moment a row of the journal names it, with its
load, its number of rows and its last key.  All parts of a load are named by
one small file, so they appear together or not at all, however many jobs wrote
them and wherever a run broke off: what a broken run left behind is in no part.

- An append (L1, L4) publishes one part more.
- A full refresh (L3) publishes a part that takes the place of all before it.
- A later step of a load reads the load's own part, not the history.

In the catalog a table is a view over a partitioned table: an append adds a
part's partitions in one call, and a refresh prepares a new table beside the
old one and then replaces the view in one call.  A query that runs meanwhile
sees the table as it was (the table before the last refresh is kept); there is
no moment without it.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.operators.partitions import PARTITION_COLUMN, with_partition
from ingot.session import drop_folder

BRONZE = "bronze.ecommerce_behavior"
BRONZE_REJECTS = "bronze.ecommerce_behavior_rejects"
SILVER = "silver.ecommerce_behavior"
DIM_PRODUCTS = "gold.dim_products"
DIM_REJECTS = "gold.dim_products_rejects"
FACT = "gold.fact_ecommerce"
DQ_RESULTS = "gold.dq_results"
DQ_METRICS = "gold.dq_metrics"
PROFILES = "gold.profile_states"

#: Columns and types, without the partition columns.
_DDL = {
    BRONZE: """
        event_time TIMESTAMP_NTZ, event_type VARCHAR(50), product_id BIGINT,
        category_id BIGINT, category_code VARCHAR(100), brand VARCHAR(50),
        price DECIMAL(10,2), user_id BIGINT, user_session VARCHAR(36),
        loaded_at TIMESTAMP, source_file STRING""",
    BRONZE_REJECTS: """
        event_time TIMESTAMP_NTZ, event_type STRING, product_id BIGINT,
        category_id BIGINT, category_code STRING, brand STRING,
        price DECIMAL(10,2), user_id BIGINT, user_session STRING,
        source_file STRING, reject_reason STRING, loaded_at TIMESTAMP""",
    SILVER: """
        event_date DATE, event_time_only STRING, event_type VARCHAR(50),
        product_id BIGINT, category_id BIGINT, category VARCHAR(100),
        subcategory VARCHAR(100), brand VARCHAR(50), price DECIMAL(10,2),
        user_id BIGINT, user_session VARCHAR(36)""",
    DIM_PRODUCTS: """
        product_id BIGINT, category_id BIGINT, brand VARCHAR(50)""",
    DIM_REJECTS: """
        category_id BIGINT, brand STRING, events BIGINT, reject_reason STRING,
        loaded_at TIMESTAMP""",
    FACT: """
        event_key BIGINT, event_date DATE, event_time_only STRING,
        event_type VARCHAR(50), product_id BIGINT, category VARCHAR(100),
        subcategory VARCHAR(100), price DECIMAL(10,2), user_id BIGINT,
        user_session VARCHAR(36)""",
    DQ_RESULTS: """
        run_at TIMESTAMP, layer STRING, check_name STRING, violations BIGINT,
        status STRING""",
    DQ_METRICS: """
        run_at TIMESTAMP, layer STRING, check_name STRING, metric STRING, value BIGINT,
        status STRING""",
    PROFILES: """
        table_name STRING, folder STRING, kind STRING, name STRING, n BIGINT, value STRING, sketch BINARY""",
}
#: Tables whose parts have a folder for each month.
_BY_MONTH = {SILVER, FACT}
LOAD = "load_id"
_JOURNAL = f"at TIMESTAMP, {LOAD} STRING, table STRING, mode STRING, folder STRING, months ARRAY<STRING>, rows BIGINT, first_key BIGINT, last_key BIGINT"


#: What the catalog of this application shows: (application, table) -> (root,
#: name of the stored table, folders of its parts).
_SHOWN: dict[tuple[str, str], tuple[str, str, list[str]]] = {}


@dataclass
class Part:
    """A folder written for a table by a load, and what it holds."""

    load_id: str
    table: str
    mode: str
    folder: str
    months: list[str]
    rows: int
    first_key: int | None = None
    last_key: int | None = None


def _schema(table: str) -> T.StructType:
    """Columns of a part; widths are checked apart from the types."""
    by = f", {PARTITION_COLUMN} STRING" if table in _BY_MONTH else ""
    return T.StructType.fromDDL(re.sub(r"VARCHAR\(\d+\)", "STRING", " ".join(_DDL[table].split()) + by))


def _widths(table: str) -> dict[str, int]:
    return {name: int(n) for name, n in re.findall(r"(\w+) VARCHAR\((\d+)\)", _DDL[table])}


@dataclass
class Lakehouse:
    """Catalog tables of the pipeline under `root` (a shared folder).

    `bounds`: RANGE LEFT month ends to partition by; calendar months if None.
    """

    spark: SparkSession
    root: str
    bounds: tuple[str, ...] | None = None

    def path(self, table: str) -> str:
        db, name = table.split(".")
        return f"{self.root.rstrip('/')}/{db}/{name}"

    # --- journal ------------------------------------------------------------------

    def _journal_folder(self) -> str:
        return f"{self.root.rstrip('/')}/_journal"

    def journal(self) -> DataFrame:
        """One row for each part ever published."""
        try:
            return self.spark.read.schema(_JOURNAL).parquet(self._journal_folder())
        except AnalysisException:  # nothing published yet
            return self.spark.createDataFrame([], _JOURNAL)

    @staticmethod
    def _part(r) -> Part:
        return Part(r[LOAD], r["table"], r["mode"], r["folder"], list(r["months"]), r["rows"], r["first_key"], r["last_key"])

    def parts(self, *tables: str) -> dict[str, list[Part]]:
        """The parts in use of each table (all by default), oldest first: those
        since its last refresh."""
        names = list(tables or _DDL)
        found: dict[str, list[Part]] = {t: [] for t in names}
        for r in self.journal().where(F.col("table").isin(names)).orderBy("at").collect():
            if r["mode"] == "overwrite":
                found[r["table"]].clear()
            found[r["table"]].append(self._part(r))
        return found

    def load_parts(self, load_id: str) -> dict[str, Part]:
        """The parts that a load published, by table; none if it did not end."""
        return {r["table"]: self._part(r) for r in self.journal().where(F.col(LOAD) == load_id).collect()}

    def publish(self, *parts: Part) -> None:
        """Name all `parts` in the journal, by one file, then show them here."""
        rows = [(p.load_id, p.table, p.mode, p.folder, p.months, p.rows, p.first_key, p.last_key) for p in parts]
        named = self.spark.createDataFrame(rows, _JOURNAL.split(", ", 1)[1]).coalesce(1)
        named.select(F.current_timestamp().alias("at"), "*").write.mode("append").parquet(self._journal_folder())
        for p in parts:
            self._show(p.table, [p], anew=p.mode == "overwrite")

    # --- parts --------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, load_id: str, mode: str = "append", key: str | None = None, by_month: bool = False) -> Part:
        """Write `df` as a part of `table` without publishing it.  Text longer
        than its column stops the write, as an insert would.  `by_month`: the
        tasks of `df` already have few months each, so nothing is shuffled."""
        folder, counter = f"{self.path(table)}/part={mode}-{uuid.uuid4().hex}", Observation(f"part_{uuid.uuid4().hex}")
        seen = [F.count(F.lit(1)).alias("rows")] + ([F.min(key).alias("first"), F.max(key).alias("last")] if key else [])
        out = self._ordered(df.observe(counter, *seen), table, by_month)
        writer = out.write.partitionBy(PARTITION_COLUMN) if table in _BY_MONTH else out.write
        writer.parquet(folder)
        got = observed(counter)
        rows = got["rows"] if got else self.spark.read.schema(_schema(table)).parquet(folder).count()
        return Part(load_id, table, mode, folder, self._months(folder) if table in _BY_MONTH else [], int(rows), got.get("first"), got.get("last"))

    def read(self, *parts: Part) -> DataFrame:
        """The rows of parts of one table: their files and no others."""
        schema, top = _schema(parts[0].table), self.path(parts[0].table)
        return self.spark.read.schema(schema).option("basePath", top).parquet(*[p.folder for p in parts]).select(*schema.names)

    def frozen(self, table: str) -> DataFrame:
        """The rows a table has now, whatever is published later."""
        parts = [p for p in self.parts(table)[table] if p.rows]
        return self.read(*parts) if parts else self.spark.createDataFrame([], _schema(table))

    def _months(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION_COLUMN}="))

    def _ordered(self, df: DataFrame, table: str, by_month: bool = False) -> DataFrame:
        widths = _widths(table)

        def value(f: T.StructField):
            if f.name not in df.columns:
                return F.lit(None).cast(f.dataType).alias(f.name)
            c = F.col(f.name).cast(f.dataType)
            if f.name in widths:
                c = F.when(F.length(c) > widths[f.name], F.raise_error(F.lit(f"{table}.{f.name} is longer than {widths[f.name]}")).cast(f.dataType)).otherwise(c)
            return c.alias(f.name)

        out = df.select(*[value(f) for f in _schema(table)])
        # each writer would else write a file per month: rows are grouped by
        # month first, and AQE splits a heavy month into advisory-size
        # pieces, so no task gets a whole hot partition
        return out.hint("rebalance", PARTITION_COLUMN) if table in _BY_MONTH and not by_month else out

    # --- catalog --------------------------------------------------------------------

    def _key(self, table: str) -> tuple[str, str]:
        return self.spark.sparkContext.applicationId, table

    def _stored(self, table: str) -> str:
        """The partitioned table behind the view."""
        if _SHOWN.get(self._key(table), [None])[0] != self.root:
            self.refresh(table)
        return _SHOWN[self._key(table)][1]

    def _show(self, table: str, parts: list[Part], anew: bool = False) -> None:
        """Add `parts` to the stored table; with `anew`, to a new one that then
        takes the place of the old one."""
        key = self._key(table)
        root, name, folders = _SHOWN.get(key, (None, None, []))
        if not anew and root == self.root:
            self._add(name, parts)
            folders += [p.folder for p in parts]
            return
        by = [f"{LOAD} STRING"] + [f"{PARTITION_COLUMN} STRING"] * (table in _BY_MONTH)
        tag = hashlib.sha256(self.root.encode()).hexdigest()[:8]
        name = f"{table}_{int(time.time() * 1e6):016x}_{tag}"
        self.spark.sql(f"CREATE TABLE {name} ({_DDL[table]}, {', '.join(by)}) USING parquet PARTITIONED BY ({', '.join(c.split()[0] for c in by)}) LOCATION '{self.path(table)}/_table'")
        self._add(name, parts)
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {name}")
        _SHOWN[key] = (self.root, name, [p.folder for p in parts])
        db, short = table.split(".")
        pattern = re.compile(re.escape(short) + r"_[0-9a-f]{16}_[0-9a-f]{8}")
        old = sorted(r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {db} LIKE '{short}_*'").collect() if pattern.fullmatch(r["tableName"]))
        for other in old[:-2]:
            self.spark.sql(f"DROP TABLE IF EXISTS {db}.{other}")

    def _add(self, name: str, parts: list[Part]) -> None:
        specs = []
        for p in (p for p in parts if p.rows):
            load = p.load_id.replace("\\", "\\\\").replace("'", "\\'")
            specs += [f"PARTITION ({LOAD} = '{load}', {PARTITION_COLUMN} = '{m}') LOCATION '{p.folder}/{PARTITION_COLUMN}={m}'" for m in p.months]
            if p.table not in _BY_MONTH:
                specs.append(f"PARTITION ({LOAD} = '{load}') LOCATION '{p.folder}'")
        if specs:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")

    def create(self, recreate: bool = False) -> None:
        """CREATE DATABASE and tables (L5), showing the published parts; fresh
        tables on recreate, which no row of an earlier run can reach."""
        for db in ("bronze", "silver", "gold"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.root.rstrip('/')}/{db}'")
        if recreate:
            load_id = f"recreate-{uuid.uuid4().hex}"
            self.publish(*[Part(load_id, t, "overwrite", f"{self.path(t)}/part=overwrite-{uuid.uuid4().hex}", [], 0) for t in _DDL])
        else:
            self.refresh()

    def refresh(self, *tables: str) -> None:
        """Show what other applications have published since."""
        for t, parts in self.parts(*tables).items():
            root, _, folders = _SHOWN.get(self._key(t), (None, None, []))
            if root != self.root or folders != [p.folder for p in parts]:
                self._show(t, parts, anew=True)

    def partitions(self, table: str) -> DataFrame:
        """`SHOW PARTITIONS` of a stored table (M3)."""
        return self.spark.sql(f"SHOW PARTITIONS {self._stored(table)}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._stored(name))

    def partitioned(self, df: DataFrame) -> DataFrame:
        """`df` with the partition column of its `event_date`."""
        return with_partition(df, "event_date", self.bounds)

    # --- single writes ------------------------------------------------------------------

    def append(self, df: DataFrame, table: str) -> Part:
        """INSERT INTO (L1, L4): one part, published at once."""
        part = self.write(df, table, uuid.uuid4().hex)
        self.publish(part)
        return part

    def overwrite(self, df: DataFrame, table: str) -> Part:
        """TRUNCATE + INSERT ... SELECT (L3): all of `df` and nothing else.  The
        old parts stay in their folders until `vacuum`."""
        part = self.write(df, table, uuid.uuid4().hex, "overwrite")
        self.publish(part)
        return part

    def vacuum(self, table: str) -> int:
        """Delete the folders of parts no longer in use, and those of loads that
        broke off; returns how many.  Not beside a running load."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs, keep = top.getFileSystem(self.spark._jsc.hadoopConfiguration()), {p.folder.rsplit("/", 1)[-1] for p in self.parts(table)[table]}
        gone = [s.getPath().toString() for s in (fs.listStatus(top) if fs.exists(top) else []) if s.getPath().getName() not in keep]
        return sum(drop_folder(self.spark, g) for g in gone)


def observed(counter: Observation) -> dict:
    """The metrics of a finished write; none if its plan was found to be empty
    before it ran (AQE then leaves out the node that counts)."""
    try:
        return counter.get
    except Py4JJavaError:
        return {}


def stamp(df: DataFrame, col: str = "loaded_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())
