"""Egress CSV exports: scan, load a directory tree, catalog listing.

Exports arrive as CSV files named ``<prefix> - <table>.csv`` in a tree
of folders.  The table names are found by Spark (a ``binaryFile`` scan
that reads paths only, never file contents), each table is read with one
``spark.read.csv`` over all its files, and registered as a temp view
(or saved as a table).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed CSV dialect of the exports: header row, double-quote escaping.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}
TABLE_NAME_SEPARATOR = " - "


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None,
             infer_schema: bool = False, multi_line: bool = True, options: dict | None = None) -> DataFrame:
    """Read export CSV.

    Pass ``schema`` in production: inference is an extra full pass.
    Quoted fields may hold line breaks, which makes every file a single
    task; ``multi_line=False`` splits files that are known to have none.
    """
    reader = spark.read.options(**CSV_OPTIONS, **(options or {})).option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def table_name_of(file_name: str) -> str:
    """``"Sample - invoice.csv"`` -> ``"invoice"`` (text after the first
    separator, extension dropped)."""
    base = file_name.rsplit("/", 1)[-1]
    if TABLE_NAME_SEPARATOR in base:
        base = base.split(TABLE_NAME_SEPARATOR, 1)[1]
    return base[:-4] if base.lower().endswith(".csv") else base


def list_csv_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of all ``*.csv`` files under ``root`` (recursive).

    Only file paths reach the driver (metadata, one row per file).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(root).select("path"))
    return sorted(r["path"] for r in files.collect())


def table_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables that have files under ``root``: one row a
    table reaches the driver, however many files it has."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(root))
    base = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.csv$", "")
    cut = F.instr(base, TABLE_NAME_SEPARATOR)
    name = F.when(cut > 0, F.substring(base, cut + len(TABLE_NAME_SEPARATOR), F.length(base))).otherwise(base)
    return sorted(r["name"] for r in files.select(name.alias("name")).distinct().collect())


def _files_of(spark: SparkSession, root: str, name: str, names: list[str]) -> tuple[dict, list[str] | str]:
    """(reader options, path) that select the files of one table."""
    if any(other.endswith(TABLE_NAME_SEPARATOR + name) for other in names):
        # "a - b - t.csv" belongs to table "b - t", but a pattern for "t" takes it too.
        return {}, [p for p in list_csv_files(spark, root) if table_name_of(p) == name]
    literal = re.sub(r"([\\*?\[\]{},^])", r"\\\1", name)
    pattern = f"{{*{TABLE_NAME_SEPARATOR}{literal},{literal}}}.csv"
    return {"recursiveFileLookup": "true", "pathGlobFilter": pattern}, root


def load_egress_dir(spark: SparkSession, root: str, schemas: dict[str, StructType | str] | None = None,
                    infer_schema: bool = False, multi_line: bool = True,
                    register: bool = True) -> dict[str, DataFrame]:
    """Read every table of an export tree; optionally register views.

    Files of the same table (e.g. several parts) are read together, by a
    pattern of their names: the scan lists them, not the caller.
    """
    out = {}
    names = table_names(spark, root)
    for name in names:
        schema = (schemas or {}).get(name)
        options, path = _files_of(spark, root, name, names)
        df = read_csv(spark, path, schema=schema, infer_schema=infer_schema and schema is None,
                      multi_line=multi_line, options=options)
        if register:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """``CREATE TABLE name AS SELECT ..``: fails when it already exists
    unless ``mode`` says otherwise."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def describe_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """One row per (table, column, type) of the session catalog.

    Catalog metadata only (a few rows per table), built on the driver.
    """
    rows = []
    tables = spark.catalog.listTables()
    for t in tables:
        if names is not None and t.name not in names:
            continue
        for c in spark.catalog.listColumns(t.name):
            rows.append((t.name, c.name, c.dataType, bool(t.isTemporary)))
    schema = "table string, column string, data_type string, is_temporary boolean"
    return spark.createDataFrame(rows, schema).orderBy("table", F.monotonically_increasing_id())


def parse_dict_text_columns(df: DataFrame, columns: dict[str, StructType | str]) -> DataFrame:
    """Columns exported as Python-dict/list text (``{'a': 1, 'b': None}``)
    back to typed structs/arrays, in place.  Built-in expressions only."""
    from ledgerline.functions.parsing import pydict_to_struct
    out = df
    for name, dtype in columns.items():
        out = out.withColumn(name, pydict_to_struct(F.col(name), dtype))
    return out
