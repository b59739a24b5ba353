"""Writing results: CSV reports, JSON records, build-once outputs.

Data is written in parallel, one file per task.  One single CSV file, and
with it one writing task, comes only on explicit request.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ledgerline.sources.egress import CSV_OPTIONS


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV holds only scalars."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with a header row and ``"``-escaped quotes.

    ``single_file=True`` writes one part file, through one task: for
    reports that the caller knows to be small.
    """
    out = csv_ready(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> None:
    """JSON lines with null fields kept; ``partition_by=["customer_id"]``
    gives one folder per customer (the per-customer invoice files of the
    ingest)."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_json_by_key(df: DataFrame, path: str, key: str, files: int | None = None, max_records: int = 1_000_000,
                      mode: str = "overwrite") -> None:
    """JSON lines in one folder per ``key`` value (the per-customer
    invoice files of the ingest), in few files.

    Rows are range-partitioned by the key into ``files`` tasks, with a
    random tie-breaker, so a task holds neighbouring keys whole: there
    are at most as many files as keys plus tasks, not tasks times keys.
    A hot key is cut over several tasks, and into files of at most
    ``max_records`` rows.  Each task writes one file at a time.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clustered = df.repartitionByRange(n, F.col(key).asc_nulls_first(), F.rand(11)).sortWithinPartitions(key)
    (clustered.write.mode(mode).option("ignoreNullFields", "false").option("maxRecordsPerFile", max_records)
     .partitionBy(key).json(path))


COMMITTED = "COMMITTED"  # no underscore: Spark does not read such files


def committed(spark: SparkSession, path: str) -> str | None:
    """The folder of the build that ``path`` stands for, or None."""
    try:
        return f"{path.rstrip('/')}/{spark.read.text(path.rstrip('/') + '/' + COMMITTED).first()[0]}"
    except AnalysisException:
        return None


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file; False if the target is there already (one atomic
    step in the file system)."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path, to = jvm.Path(source), jvm.Path(target)
    context = jvm.FileContext.getFileContext(path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(),
                                             spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    try:
        context.rename(path, to, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.toString():
            raise
        return False
    return True


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """The folder of the one committed build of ``path``.

    A build that is committed is used as it is.  Otherwise ``write`` fills
    a folder of its own, which no reader looks at, and a marker with its
    name is renamed into place.  Only one marker can be: whoever comes
    second finds the first's and adopts its build, so two applications
    that build at once neither disturb each other nor disagree, and a
    build that failed half-way is never read.
    """
    done = committed(spark, path)
    if done:
        return done
    root, name = path.rstrip("/"), f"build-{uuid.uuid4().hex}"
    write(f"{root}/{name}")
    own = f"{root}/_marker-{name}"
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(own).getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(jvm.Path(own), False)
    out.write(bytearray(name.encode()))
    out.close()
    _rename(spark, own, f"{root}/{COMMITTED}")
    return committed(spark, path)


def build_once(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """Reuse the committed build of ``path``, or build, commit and read it
    (:func:`publish`).  The plan of a build isn't even constructed where
    there is one."""
    folder = publish(spark, path, lambda to: build().write.format(fmt).save(to))
    return spark.read.format(fmt).load(folder)


def month_column(ts_col: str) -> str:
    return f"{ts_col}_month"


def write_by_month(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by the month of ``ts_col`` (a ``yyyy-MM``
    folder per month), so date-bounded reads skip whole months."""
    month = F.date_format(F.col(ts_col), "yyyy-MM")
    (df.withColumn(month_column(ts_col), month)
     .write.mode(mode).partitionBy(month_column(ts_col)).parquet(path))


def read_time_range(spark: SparkSession, path: str, ts_col: str, start: str, end: str,
                    whole_last_day: bool = False) -> DataFrame:
    """Rows of a month-partitioned table with ``start <= ts <= end``.

    The month predicate prunes partitions (only the folders of the
    months in range are listed and read); the exact timestamp predicate
    keeps the result identical to filtering the whole table.
    """
    from ledgerline.operators.filters import ts_range
    df = spark.read.parquet(path)
    m = F.col(month_column(ts_col))
    months = (m >= F.lit(start[:7])) & (m <= F.lit(end[:7]))
    return df.where(months).where(ts_range(ts_col, start, end, whole_last_day)).drop(month_column(ts_col))
