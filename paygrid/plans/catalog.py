"""Catalog tables: create-if-missing from the contracts, upsert into them.

Deploying the mart means creating its three tables if they do not exist;
an existing table keeps its types, whichever variant created it.  So writes
conform the batch to the schema the table *has*, not to the variant asked
for — an insert into an existing table casts to that table's columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import batch_partitions, delete_path, list_folders, merge_by_key, stage
from .contracts import Contract, conform, contract

PARTITION_COLUMN = "week_dt"
#: Folder of swapped months inside a table's own; its name hides it from readers of the whole folder.
MONTHS_FOLDER = "_months"


def _default_sql(value) -> str:
    if value == "now":
        return "current_timestamp()"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def create_table_sql(spec: Contract, name: str, location: str | None = None) -> str:
    def column(f: T.StructField) -> str:
        sql = f"`{f.name}` {f.dataType.simpleString()}"
        if not f.nullable:
            sql += " NOT NULL"
        if f.name in spec.defaults:
            sql += f" DEFAULT {_default_sql(spec.defaults[f.name])}"
        return sql
    cols = ",\n  ".join(column(f) for f in spec.schema.fields)
    where = f"\nLOCATION '{location}'" if location else ""
    return (f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet\n"
            f"PARTITIONED BY ({PARTITION_COLUMN}){where}")


def ensure_tables(spark: SparkSession, names: dict[str, str], variant: str = "wide",
                  location_root: str | None = None) -> None:
    """Create each missing table (``names``: table kind -> catalog name)."""
    for kind, name in names.items():
        location = f"{location_root.rstrip('/')}/{kind}" if location_root else None
        spark.sql(create_table_sql(contract(kind, variant), name, location))


def created_variant(schema: T.StructType, kind: str = "features") -> str | None:
    """Which contract variant a table's column types come from (None: neither)."""
    types = {f.name: f.dataType for f in schema.fields}
    for variant in ("compact", "wide"):
        declared = {f.name: f.dataType for f in contract(kind, variant).schema.fields}
        if types == declared:
            return variant
    return None


def table_contract(spark: SparkSession, name: str, kind: str = "features") -> Contract:
    """The contract of an existing catalog table (see :func:`contract_for_schema`)."""
    return contract_for_schema(spark.table(name).schema, kind)


def contract_for_schema(schema: T.StructType, kind: str = "features") -> Contract:
    """The contract of an existing table: its own column types, the keys and
    defaults of its kind, and the CHECKs of the variant that created it."""
    variant = created_variant(schema, kind)
    declared = contract(kind, variant or "wide")
    # Catalog schemas report every column nullable; keep the declared NOT NULLs.
    required = {f.name for f in declared.schema.fields if not f.nullable}
    fields = [T.StructField(f.name, f.dataType, f.name not in required) for f in schema.fields]
    checks = declared.checks if variant else {}
    defaults = {c: v for c, v in declared.defaults.items() if c in schema.names}
    return Contract(declared.name, T.StructType(fields), declared.keys, checks, defaults)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def month_locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Month -> folder of every month of the table (one row a month: bounded by the calendar)."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        month = row[0].split("=", 1)[1]
        detail = spark.sql(f"DESCRIBE FORMATTED {name} PARTITION ({PARTITION_COLUMN} = DATE'{month}')").where("col_name = 'Location'")
        out[month] = detail.first()["data_type"]
    return out


def swap_months(rows: DataFrame, name: str, max_records_per_file: int = 5_000_000) -> None:
    """Replace the months that ``rows`` have: write them to a fresh folder, then move each month's location there.

    A move is one change of the catalog, so a reader sees a month as it was or as it is, never a part of it, and
    one that has begun keeps reading the old files.  The data is written once.  A run that fails before the moves
    changes nothing; between two moves every month is whole.  Old folders stay until :func:`drop_old_months`.
    """
    spark = rows.sparkSession
    fresh = f"{_location(spark, name)}/{MONTHS_FOLDER}/{uuid.uuid4().hex}"
    (rows.hint("rebalance", PARTITION_COLUMN).write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(PARTITION_COLUMN).parquet(fresh))
    months = batch_partitions(spark.read.parquet(fresh), PARTITION_COLUMN)
    known = {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for month in sorted(months):
        at = f"PARTITION ({PARTITION_COLUMN} = DATE'{month}')"
        folder = f"'{fresh}/{PARTITION_COLUMN}={month}'"
        if str(month) in known:
            spark.sql(f"ALTER TABLE {name} {at} SET LOCATION {folder}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {at} LOCATION {folder}")
    spark.catalog.refreshTable(name)


def drop_old_months(spark: SparkSession, name: str) -> list[str]:
    """Delete the folders of replaced months; call it when no reader from before the last swap is left."""
    used = {_plain(x) for x in month_locations(spark, name).values()}
    root = _location(spark, name)
    gone = []
    # months written in place, and those of earlier swaps
    for folder in [root, *list_folders(spark, f"{root}/{MONTHS_FOLDER}")]:
        for month in list_folders(spark, folder):
            if month.rsplit("/", 1)[1].startswith(f"{PARTITION_COLUMN}=") and _plain(month) not in used:
                delete_path(spark, month)
                gone.append(month)
    return gone


def _plain(path: str) -> str:
    """A path without its scheme, as catalogs and file systems write it differently."""
    return path.split(":", 1)[-1].replace("//", "/").rstrip("/")


def upsert_table(batch: DataFrame, name: str, spec: Contract,
                 batch_is_staged: bool = False) -> DataFrame:
    """Merge ``batch`` into catalog table ``name`` by the contract's keys.

    Only the months that the batch touches are read; their merged rows are written to a fresh folder and swapped
    in by :func:`swap_months`, so the months being read are never overwritten and need no staged copy.
    """
    spark = batch.sparkSession
    staged = batch if batch_is_staged else stage(conform(batch, spec), "table-batch")
    months = batch_partitions(staged, PARTITION_COLUMN)
    if not months:
        return staged
    touched = spark.table(name).where(F.col(PARTITION_COLUMN).isin(months))
    swap_months(merge_by_key(touched, staged, spec.keys).select(*spec.columns), name)
    return staged
