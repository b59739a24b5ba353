"""Reading landed API pages and validating records.

Pages land as files (JSON lines, or one envelope per file) in a shared
folder; Spark reads them with a declared schema, so no schema inference
pass and no per-row Python.  Validation is expressed with column
predicates:

* every leaf number is read as text, must look like a number, and is cast
  with ``try_cast``, so a bad value is reported instead of silently
  becoming null;
* required fields (``schemas.REQUIRED``), nested ones too, must be
  present and non-null;
* every record gets a list of reasons; no reason means valid.

``validate_records`` returns ``(valid, rejects)``: one bad record does
not drop its page-mates (``all_or_nothing=True`` restores the stricter
behaviour of dropping a whole page when any of its records is bad, done
with a distributed anti join on the page id, over a staged table of one
parse).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DoubleType, LongType, MapType, StringType,
                               StructType)

from ledgerline import schemas
from ledgerline.session import scratch_path


def read_pages(spark: SparkSession, path: str, record: StructType, multi_line: bool = False,
               single: bool = False) -> DataFrame:
    """Read page envelopes ``{"data": [...], "next_page", "error"}``.

    ``multi_line=True`` for pretty-printed one-envelope-per-file pages
    (one task per file); JSON lines (one envelope per line) split freely.

    A page with text that is no envelope, or with a value that is not of
    its declared type, has the fault as its ``error``, whichever columns
    are read later: each page is found by either ``explode_pages`` or
    ``page_errors``.  Numbers are parsed as text for that.  To keep the
    good records of such a page use :mod:`ledgerline.sources.intake`.
    """
    schema = schemas.page_schema(schemas.as_text_leaves(record), single=single).add("_unreadable", StringType())
    pages = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_unreadable").json(path)
             .select("*", F.col("_metadata.file_path").alias("source_file")))
    data = F.col("data")
    faults = _bad_number_reasons(data, record if single else ArrayType(record), "data")
    # The size reads ``data`` whole, so that no pruning hides a fault from the parser.
    all_read = F.lit(False) if single else F.size(data) < -1
    error = F.coalesce("error", F.when(F.col("_unreadable").isNotNull() | all_read,
                                       F.concat(F.lit("unreadable page: "), F.col("_unreadable"))), *faults)
    typed = data if not _has_numeric(record) else _typed(data, record if single else ArrayType(record))
    return pages.withColumn("error", error).withColumn("data", typed).drop("_unreadable")


def explode_pages(pages: DataFrame) -> DataFrame:
    """Records of pages without an error; a missing ``data`` gives none."""
    ok = pages.where(F.col("error").isNull())
    extra = [c for c in ("source_file", "page_no") if c in pages.columns]
    return ok.select(*extra, F.explode_outer("data").alias("r")).where(F.col("r").isNotNull()) \
        .select(*extra, "r.*")


def page_errors(pages: DataFrame) -> DataFrame:
    """Error envelopes, routed aside with their message."""
    extra = [c for c in ("source_file", "page_no") if c in pages.columns]
    return pages.where(F.col("error").isNotNull()).select(*extra, "error")


def read_raw_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Unvalidated passthrough: one text column per record, no schema
    (fields are read later with ``get_json_object`` / ``from_json``)."""
    if multi_line:
        return spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "json")
    return spark.read.text(path).withColumnRenamed("value", "json")


def read_raw_variant(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Unvalidated passthrough with structure: one variant column
    ``record`` for each record, parsed once in the scan; text that is no
    JSON has a null record and itself in ``unreadable``."""
    odd = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    read = (spark.read.schema(f"record variant, `{odd}` string").option("singleVariantColumn", "record")
            .option("multiLine", multi_line))
    return read.json(path).withColumnRenamed(odd, "unreadable")


def variant_elements(df: DataFrame, path: str = "$", column: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each element of the array at ``path``."""
    inner = F.try_variant_get(F.col(column), path, "array<variant>")
    return df.select(*keep, F.explode(inner).alias(column))


def discover_schema(df: DataFrame, column: str = "record") -> str:
    """The schema that holds every record, as DDL text: one aggregate."""
    return df.agg(F.schema_of_variant_agg(column)).first()[0]


# What a number looks like; a cast alone would also take "12d" or "NaN".
NUMBER = {DoubleType: r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$",
          LongType: r"^\s*[+-]?[0-9]+(\.0*)?\s*$"}


def _lacks(value: Column, path: list[str]) -> Column:
    """Whether a required field is missing where its parent is there."""
    field, rest = value.getField(path[0].removesuffix("[]")), path[1:]
    if path[0].endswith("[]"):
        bad = F.exists(field, lambda e: e.isNotNull() & _lacks(e, rest) if rest else e.isNull())
        return F.coalesce(bad, F.lit(False))
    return field.isNotNull() & _lacks(field, rest) if rest else field.isNull()


def _number(text: Column, dtype: DataType) -> Column:
    """Text as a number; ``5.0`` is an integer too."""
    if isinstance(dtype, LongType):
        return F.coalesce(text.try_cast(dtype), text.try_cast("decimal(38,10)").try_cast(dtype))
    return text.try_cast(dtype)


def _typed(field_text: Column, dtype: DataType) -> Column:
    """Text-read value back to its declared type (nested numbers too)."""
    if isinstance(dtype, (DoubleType, LongType)):
        return _number(field_text, dtype)
    if isinstance(dtype, StructType):
        return F.when(field_text.isNotNull(), F.struct(*[
            _typed(field_text.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, (StructType, DoubleType, LongType)):
        return F.transform(field_text, lambda x: _typed(x, dtype.elementType))
    if isinstance(dtype, MapType):
        return field_text.cast(dtype) if not isinstance(dtype.valueType, StringType) else field_text
    return field_text


def _has_numeric(dtype: DataType) -> bool:
    if isinstance(dtype, (DoubleType, LongType)):
        return True
    if isinstance(dtype, StructType):
        return any(_has_numeric(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _has_numeric(dtype.elementType)
    return False


def _bad_number_reasons(text: Column, dtype: DataType, path: str) -> list[Column]:
    """One reason per numeric leaf that is present but not a number."""
    out = []
    if isinstance(dtype, (DoubleType, LongType)):
        number = text.rlike(NUMBER[type(dtype)]) & _number(text, dtype).isNotNull()
        out.append(F.when(text.isNotNull() & ~number, F.lit(f"{path}: not a number")))
    elif isinstance(dtype, StructType):
        for f in dtype.fields:
            out += _bad_number_reasons(text.getField(f.name), f.dataType, f"{path}.{f.name}")
    elif isinstance(dtype, ArrayType) and isinstance(dtype.elementType, (StructType, DoubleType, LongType)):
        if _has_numeric(dtype.elementType):
            # Any element with a bad number flags the array path once.
            cond = F.exists(text, lambda x: F.size(F.array_compact(F.array(
                *_bad_number_reasons(x, dtype.elementType, f"{path}[]")))) > 0)
            out.append(F.when(F.coalesce(cond, F.lit(False)), F.lit(f"{path}: not a number")))
    return out


def validate_records(parsed_text: DataFrame, record: StructType, required: list[str],
                     record_col: str = "r", keep: list[str] | None = None,
                     all_or_nothing_by: str | None = None,
                     timestamp_fields: list[str] | None = None,
                     fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split records read with text leaves into ``(valid, rejects)``.

    ``parsed_text`` has a struct column ``record_col`` parsed with
    ``schemas.as_text_leaves(record)``.  ``valid`` has the record's
    fields typed as declared plus ``keep`` columns; ``rejects`` has
    ``keep`` columns, the record as JSON text and ``reasons``.
    ``all_or_nothing_by`` names a page column: a page with any reject
    contributes no valid records.  The records are then parsed once for
    both, bad pages and valid records, when this is called: into a staged
    table in the shared folder.  ``timestamp_fields`` (top-level text
    fields) come out as ``timestamp_ntz``; text that is not a timestamp
    is a reject reason.  ``fields``: the fields of the record that
    ``valid`` is to have, and the staged table with it (default all);
    every field is checked.
    """
    keep = keep or []
    ts = set(timestamp_fields or [])
    r = F.col(record_col)
    reasons = [F.when(_lacks(r, n.split(".")), F.lit(f"{n}: missing")) for n in required]
    for f in record.fields:
        reasons += _bad_number_reasons(r.getField(f.name), f.dataType, f.name)
    for n in sorted(ts):
        t = r.getField(n)
        reasons.append(F.when(t.isNotNull() & t.try_cast("timestamp_ntz").isNull(), F.lit(f"{n}: not a timestamp")))
    checked = parsed_text.withColumn("reasons", F.array_compact(F.array(*reasons)))
    is_valid = F.size("reasons") == 0

    def typed(f):
        if f.name in ts:
            return r.getField(f.name).try_cast("timestamp_ntz")
        return _typed(r.getField(f.name), f.dataType)
    valid_fields = [typed(f).alias(f.name) for f in record.fields if fields is None or f.name in fields]
    rejects = checked.where(~is_valid).select(*keep, F.to_json(r).alias("record"), "reasons")
    if all_or_nothing_by is None:
        return checked.where(is_valid).select(*keep, *valid_fields), rejects
    found = checked.select(F.struct(*keep).alias("kept"), is_valid.alias("is_valid"),
                           F.when(is_valid, F.struct(*valid_fields)).alias("r"))
    path = scratch_path(parsed_text.sparkSession, f"validated-{uuid.uuid4().hex}")
    found.write.parquet(path)
    staged = parsed_text.sparkSession.read.schema(found.schema).parquet(path)
    bad_pages = staged.where(~F.col("is_valid")).select(f"kept.{all_or_nothing_by}").distinct()
    valid = staged.where("is_valid").select("kept.*", "r.*").join(bad_pages, all_or_nothing_by, "left_anti")
    return valid, rejects
