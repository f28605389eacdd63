"""A set of tables that is replaced as one: written beside the old set, then one pointer moves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from standings.sources.files import Manifest, delete_folder, names_in

# The part of a table that is replaced as a whole.
ALL = "all"
# Column that deals rows out to folders; the month stays a column of the files as well.
PART = "_month"


class SnapshotSet:
    """Tables under ``root``, each a folder or a folder for each month.

    ``commit`` writes every table into a new folder and then adds one version to the manifest, which names
    the folders of all tables. Readers open what one version names, so they see all tables old or all new,
    whatever happens in between: a writer that fails leaves only folders that nobody names. Months that a
    load does not stand for keep the folder they have, so history is not copied.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, self.root)

    def version(self) -> int:
        return self.manifest.read()[0]

    def tables(self) -> list[str]:
        return sorted(self.manifest.read()[1])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the last version, or of an earlier one that is still kept."""
        tables = self.manifest.read(version)[1]
        if name not in tables:
            raise KeyError(f"{self.root} has no table {name}")
        schema, parts = StructType.fromJson(tables[name]["schema"]), tables[name]["parts"]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}" for folder in parts.values()])

    def commit(
        self,
        whole: dict[str, DataFrame],
        by_month: dict[str, DataFrame] | None = None,
        months: set[int] = frozenset(),
        column: str = "month_key",
        keep: int = 2,
    ) -> int:
        """Replace ``whole`` tables, and of ``by_month`` tables the months they hold and all ``months``.

        ``keep`` versions stay readable; folders that only older ones name are deleted.
        """
        seen, tables = self.manifest.read()
        run = f"data/{uuid.uuid4().hex}"
        try:
            for name, df in whole.items():
                folder = f"{run}/{name}"
                df.write.parquet(f"{self.root}/{folder}")
                tables[name] = {"schema": df.schema.jsonValue(), "parts": {ALL: folder}}
            for name, df in (by_month or {}).items():
                tables[name] = self._months_written(df, tables.get(name), f"{run}/{name}", months, column)
            number = self.manifest.commit(seen, tables)
        except BaseException:
            delete_folder(self.spark, f"{self.root}/{run}")
            raise
        self._expire(keep)
        return number

    def _months_written(self, df: DataFrame, old: dict | None, folder: str, months: set[int], column: str) -> dict:
        (
            df.withColumn(PART, F.col(column))
            .hint("rebalance", PART)
            .write.partitionBy(PART)
            .parquet(f"{self.root}/{folder}")
        )
        parts = {m: at for m, at in (old["parts"] if old else {}).items() if int(m) not in months}
        for name in names_in(self.spark, f"{self.root}/{folder}"):
            if name.startswith(f"{PART}="):
                parts[name.partition("=")[2]] = f"{folder}/{name}"
        return {"schema": df.schema.jsonValue(), "parts": dict(sorted(parts.items()))}

    def _expire(self, keep: int) -> None:
        stay, gone = ({at for tables in each for t in tables.values() for at in t["parts"].values()} for each in self.manifest.forget(keep))
        for folder in sorted(gone - stay):
            delete_folder(self.spark, f"{self.root}/{folder}")


class CatalogSnapshots:
    """The same for a database: versioned rows under every table, views over the last commit.

    The rows of ``name`` lie in ``name_rows``, partitioned by the version that wrote them and, for tables
    kept by month, by month. A commit is one small insert into the table of versions, a single file, which names
    the version of every table and month; the views ``name`` show what the last commit names. One writer
    at a time.
    """

    VERSIONS = "published_versions"

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def _table(self, name: str) -> str:
        return f"{self.database}.`{name}`"

    def _named(self, version: str) -> str:
        return f"select * from {self._table(self.VERSIONS)} where version = {version}"

    def version(self) -> int:
        if not self.spark.catalog.tableExists(self._table(self.VERSIONS)):
            return 0
        return self.spark.table(self._table(self.VERSIONS)).agg(F.max("version")).first()[0] or 0

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def commit(
        self,
        whole: dict[str, DataFrame],
        by_month: dict[str, DataFrame] | None = None,
        months: set[int] = frozenset(),
        column: str = "month_key",
        keep: int = 2,
    ) -> int:
        """As `SnapshotSet.commit`. Rows of a commit that failed are in no view and are written over by the next."""
        seen = self.version()
        number, rows = seen + 1, []
        old = {(r["table_name"], r["month"]): r["rows_version"] for r in self.spark.sql(self._named(str(seen))).collect()} if seen else {}
        for name, df in whole.items():
            self._write(name, df, number, None)
            rows.append((number, name, None, number))
        for name, df in (by_month or {}).items():
            held = self._write(name, df, number, column)
            rows += [(number, name, m, v) for (t, m), v in old.items() if t == name and m not in held | set(months)]
            rows += [(number, name, m, number) for m in sorted(held)] or [(number, name, None, number)]
        for (name, month), version in old.items():
            if name not in whole and name not in (by_month or {}):
                rows.append((number, name, month, version))
        named = self.spark.createDataFrame(rows, "version int, table_name string, month int, rows_version int").coalesce(1)
        if seen or self.spark.catalog.tableExists(self._table(self.VERSIONS)):
            named.write.insertInto(self._table(self.VERSIONS))
        else:
            named.write.saveAsTable(self._table(self.VERSIONS))
        for name, df in {**whole, **(by_month or {})}.items():
            self._show(name, df.columns, column if name in (by_month or {}) else None)
        self._expire(number, keep, [*whole, *(by_month or {})])
        return number

    def _write(self, name: str, df: DataFrame, number: int, column: str | None) -> set[int]:
        table, parts = self._table(f"{name}_rows"), ["_version"] + ([PART] if column else [])
        rows = df.withColumn("_version", F.lit(number))
        if column:
            rows = rows.withColumn(PART, F.col(column).cast("int")).hint("rebalance", PART)
        if not self.spark.catalog.tableExists(table):
            rows.write.partitionBy(*parts).saveAsTable(table)
        else:
            self.spark.sql(f"alter table {table} drop if exists partition (_version = {number})")
            kept = [c for c in self.spark.table(table).columns]
            rows.select(*kept).write.insertInto(table)
        if not column:
            return set()
        own = self.spark.table(table).where(F.col("_version") == number)
        return {r[0] for r in own.select(PART).distinct().collect()}

    def _show(self, name: str, columns: list[str], column: str | None) -> None:
        view, rows = self._table(name), self._table(f"{name}_rows")
        last = self._named(f"(select max(version) from {self._table(self.VERSIONS)})")
        keys, shown = ("_version", "rows_version") if not column else (f"_version, {PART}", "rows_version, month")
        listed = ", ".join(f"`{c}`" for c in columns)
        text = f"select {listed} from {rows} where ({keys}) in (select {shown} from ({last}) where table_name = '{name}')"
        if any(t.name == name and t.tableType != "VIEW" for t in self.spark.catalog.listTables(self.database)):
            self.spark.sql(f"drop table {view}")
        self.spark.sql(f"create or replace view {view} as {text}")

    def _expire(self, number: int, keep: int, names: list[str]) -> None:
        held = self.spark.table(self._table(self.VERSIONS)).where(F.col("version") > number - keep)
        needed = {(r[0], r[1]) for r in held.select("table_name", "rows_version").distinct().collect()}
        for name in names:
            table = self._table(f"{name}_rows")
            for row in self.spark.sql(f"show partitions {table}").collect():
                version = int(row[0].split("/")[0].partition("=")[2])
                if version < number and (name, version) not in needed:
                    self.spark.sql(f"alter table {table} drop if exists partition (_version = {version})")
