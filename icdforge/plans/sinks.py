"""Dimension-table sinks: table actions as staged, checked publishes.

Tables are Parquet datasource tables created by DDL (so ``VARCHAR(n)`` limits
are enforced on insert) and partitioned by (ICD_Version, CMS_Fiscal_Year):
each release is one partition, slices are partition overwrites and reads by
release prune partitions.

No action removes rows before the new ones are written: ``DROP_CREATE`` fills a
table beside the old one and swaps their names, ``TRUNCATE`` and ``DELETE_*``
overwrite the partitions they replace (Spark writes to a staging folder and
moves it at job commit) and drop the partitions that have no successor
afterwards.  A load that fails leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import TableSpec

MAX_RECORDS_PER_FILE = 2_000_000
ACTIONS = ("DROP_CREATE", "TRUNCATE", "DELETE_ICD9", "DELETE_ICD10", "APPEND")


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(table: str, schema: str | None = None) -> str:
    return f"{quote_ident(schema)}.{quote_ident(table)}" if schema else quote_ident(table)


def _spark_type(sql_type: str) -> str:
    return sql_type.upper()


def create_table_ddl(name: str, spec: TableSpec) -> str:
    cols = ",\n  ".join(f"{quote_ident(c.name)} {_spark_type(c.sql_type)}" for c in spec.columns)
    parts = ", ".join(quote_ident(p) for p in spec.partition_by)
    return (
        f"CREATE TABLE {name} (\n  {cols}\n) USING parquet OPTIONS ('maxRecordsPerFile' '{MAX_RECORDS_PER_FILE}')"
        f" PARTITIONED BY ({parts})"
    )


def table_exists(spark: SparkSession, table: str, schema: str | None = None) -> bool:
    return spark.catalog.tableExists(table, schema) if schema else spark.catalog.tableExists(table)


def _partitions(spark: SparkSession, name: str) -> list[dict[str, str]]:
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # one row per release
        spec = {}
        for kv in row[0].split("/"):
            k, v = kv.split("=", 1)
            spec[k] = v
        out.append(spec)
    return out


def _drop_partitions(spark: SparkSession, name: str, spec: TableSpec, version: int | None, keep: set[tuple[int, ...]]) -> int:
    """Drop the partitions of one ICD version (all versions for None) that are
    not in ``keep``; returns how many were dropped."""
    dropped = 0
    for part in _partitions(spark, name):
        values = tuple(int(part[p]) for p in spec.partition_by)
        if values in keep or (version is not None and values[0] != int(version)):
            continue
        kv = ", ".join(f"{quote_ident(p)}={v}" for p, v in zip(spec.partition_by, values))
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({kv})")
        dropped += 1
    return dropped


@contextmanager
def _overwrite_partitions_only(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def insert(df: DataFrame, spark: SparkSession, name: str, spec: TableSpec, sort_col: str | None = None, overwrite: bool = False) -> None:
    """Write rows by name: columns are put in the table's order (partition
    columns last).  Rows are rebalanced by release - AQE merges small releases
    and splits large ones over several tasks - and sorted by code (min/max
    skipping on code lookups); the table's ``maxRecordsPerFile`` bounds the
    files.  ``overwrite`` replaces the releases that the rows hold."""
    cols = spark.table(name).columns
    parts = [c for c in spec.partition_by if c in cols]
    out = df.select(*cols)
    if parts:
        out = out.hint("rebalance", *parts).sortWithinPartitions(*parts, *([sort_col] if sort_col else []))
    if overwrite:
        with _overwrite_partitions_only(spark):
            out.write.insertInto(name, overwrite=True)
    else:
        out.write.insertInto(name, overwrite=False)


def check_action(spark: SparkSession, table: str, action: str, schema: str | None = None) -> str:
    """The action in capitals; unknown actions, and those that need a table
    that is not there, raise."""
    action = str(action).upper()
    if action not in ACTIONS:
        raise ValueError(f"unknown table action {action!r}; use one of {ACTIONS}")
    if action not in ("DROP_CREATE", "APPEND") and not table_exists(spark, table, schema):
        raise ValueError(f"table {qualified(table, schema)} must exist for action {action}")
    return action


def _swap_in(spark: SparkSession, staged: str, table: str, schema: str | None) -> None:
    """Give the staged table the name of ``table``; the old one goes last."""
    name, old = qualified(table, schema), qualified(f"{table}__old_{uuid.uuid4().hex[:8]}", schema)
    there = table_exists(spark, table, schema)
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")


def publish(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    spec: TableSpec,
    action: str,
    schema: str | None = None,
    sort_col: str | None = None,
    releases: set[tuple[int, ...]] | None = None,
) -> str:
    """Bring checked rows into the table by one of the table actions; returns
    the qualified name.  ``releases``: (version, fiscal year) of every release
    that has rows in ``df``, if the caller knows them."""
    action = check_action(spark, table, action, schema)
    name = qualified(table, schema)
    if action == "DROP_CREATE" or (action == "APPEND" and not table_exists(spark, table, schema)):
        staged = qualified(f"{table}__load_{uuid.uuid4().hex[:8]}", schema)
        spark.sql(create_table_ddl(staged, spec))
        try:
            insert(df, spark, staged, spec, sort_col)
            _swap_in(spark, staged, table, schema)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {staged}")
            raise
        return name
    if action == "APPEND":
        insert(df, spark, name, spec, sort_col)
        return name
    if releases is None:
        releases = {tuple(r) for r in df.select(*spec.partition_by).distinct().collect()}  # one row per release
    version = {"TRUNCATE": None, "DELETE_ICD9": 9, "DELETE_ICD10": 10}[action]
    ver_col = spec.partition_by[0]
    # the slice first: overwriting can be repeated, so a retry after a failure finds no rows of its own
    if any(version in (None, r[0]) for r in releases):
        own = df if version is None else df.filter(F.col(ver_col) == version)
        insert(own, spark, name, spec, sort_col, overwrite=True)
    if version is not None and any(r[0] != version for r in releases):
        insert(df.filter(F.col(ver_col) != version), spark, name, spec, sort_col)
    _drop_partitions(spark, name, spec, version, releases)
    return name


def record(spark: SparkSession, df: DataFrame, name: str, load_id: str, columns: str) -> int:
    """Keep ``df`` (columns as in the DDL ``columns``) as the slice of one load
    in a table partitioned by ``Load_Id``; a repeated load replaces its slice in
    one overwrite, so a failed write leaves the old slice.  Ids are any
    non-empty text and told apart as they are.  Returns the number of rows."""
    if not load_id:
        raise ValueError("a load needs a non-empty load_id")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, Load_Id STRING) USING parquet PARTITIONED BY (Load_Id)")
    if df.isEmpty():  # an overwrite without rows replaces no slice
        literal = load_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (Load_Id='{literal}')")
        return 0
    names = [c for c in spark.table(name).columns if c != "Load_Id"]
    with _overwrite_partitions_only(spark):
        df.select(*names, F.lit(load_id).alias("Load_Id")).write.insertInto(name, overwrite=True)
    return spark.table(name).filter(F.col("Load_Id") == load_id).count()


def replace_version_slice(existing: DataFrame, new_rows: DataFrame, version: int, version_col: str = "ICD_Version") -> DataFrame:
    """Table contents after a DELETE_ICD<version> load, as a DataFrame:
    the other version's rows plus the newly loaded slice."""
    return existing.filter(F.col(version_col) != int(version)).unionByName(new_rows)
