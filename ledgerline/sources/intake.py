"""Taking in API pages: one parse, three outcomes, nothing lost.

Every page and every record of a landing folder gets one outcome:

* ``valid``: the record, typed as declared;
* ``reject``: a record that breaks a rule, as JSON text with the reasons;
* ``page``: a page without readable records (an error envelope, text that
  ends too early, ``data`` of another shape), with its text as message.

A page that parses gives each record to ``valid`` or ``reject``.  Where
one record of a page does not fit the schema, the JSON reader marks the
whole page; such a page, and no other, is parsed again record by record,
so that its good records stay valid and the odd one is a reject with its
own text.  A null in ``data`` is a reject as well.

``take_in`` writes all outcomes in one pass over the input, as one table;
the three results read their rows and columns of it.  The table isn't
partitioned by outcome, since that would sort whole records before they
are written.  The stored table is also what makes the outcomes agree:
they come from the same parse.  ``classify`` alone is the plan without the write, for
streams and other callers that stage by themselves.

Missing is told apart from null where the entity says so
(``schemas.PRESENT``), and missing numbers get their defaults
(``schemas.DEFAULTS``); both by variant fields in the same parse.  A
missing or null ``pending_deductions`` is empty.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, StringType, StructType, VariantType

from ledgerline import schemas
from ledgerline.session import scratch_path
from ledgerline.sources.pages import NUMBER, _has_numeric, _lacks, _number

FAULT = "_fault"      # the text of a record, or page, that does not fit the schema
EMPTY_WHERE_MISSING = ("pending_deductions",)


class Intake(NamedTuple):
    valid: DataFrame      # source_file and the record's fields
    rejects: DataFrame    # source_file, record (JSON text), reasons
    pages: DataFrame      # source_file, message


def _record_schema(entity: str) -> StructType:
    return StructType(schemas.reading_schema(entity).fields).add(FAULT, StringType())


def envelope_schema(entity: str) -> StructType:
    return schemas.page_schema(_record_schema(entity)).add("_unreadable", StringType())


def read_envelopes(spark: SparkSession, path: str, entity: str, multi_line: bool = False) -> DataFrame:
    """The pages as read, with the text of those that do not fit."""
    return (spark.read.schema(envelope_schema(entity)).option("multiLine", multi_line)
            .option("columnNameOfCorruptRecord", "_unreadable").json(path)
            .select("*", F.col("_metadata.file_path").alias("source_file")))


def _faults(value: Column, dtype: DataType, read: DataType, path: str) -> list[Column]:
    """A reason for each number that is there but is none."""
    if isinstance(dtype, (DoubleType, LongType)):
        text = value.cast("string") if isinstance(read, VariantType) else value
        number = text.rlike(NUMBER[type(dtype)]) & _number(text, dtype).isNotNull()
        return [F.when(text.isNotNull() & ~number, F.lit(f"{path}: not a number"))]
    if isinstance(dtype, StructType):
        return [c for f in dtype.fields
                for c in _faults(value.getField(f.name), f.dataType, read[f.name].dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, (StructType, DoubleType, LongType)):
        if not _has_numeric(dtype.elementType):
            return []
        # The element's reasons, each path once whichever elements have it.
        found = F.flatten(F.transform(value, lambda e: F.array_compact(F.array(
            *_faults(e, dtype.elementType, read.elementType, f"{path}[]")))))
        return [F.array_join(F.array_distinct(found), "; ")]
    return []


def reasons(record: Column, entity: str) -> Column:
    """Why a record is not valid; empty if it is."""
    declared, read = schemas.ENTITIES[entity], _record_schema(entity)
    rules = [F.when(_lacks(record, n.split(".")), F.lit(f"{n}: missing"))
             for n in [*schemas.REQUIRED[entity], *schemas.PRESENT[entity]]]
    rules += _faults(record, declared, read, "")
    for n in schemas.TIMESTAMPS[entity]:
        t = record.getField(n)
        rules.append(F.when(t.isNotNull() & t.try_cast("timestamp_ntz").isNull(), F.lit(f"{n}: not a timestamp")))
    found = F.filter(F.array_compact(F.array(*rules)), lambda x: x != "")
    return (F.when(record.isNull(), F.array(F.lit("record: missing")))
            .when(record.getField(FAULT).isNotNull(), F.array(F.lit("record: does not fit the schema"))).otherwise(found))


def typed(record: Column, entity: str) -> Column:
    """The record as declared, with defaults."""
    defaults = schemas.DEFAULTS[entity]

    def cast(value: Column, dtype: DataType, read: DataType, path: str) -> Column:
        if isinstance(read, VariantType):
            text = value.cast("string")
            plain = _number(text, dtype) if isinstance(dtype, (DoubleType, LongType)) else text
            return F.when(value.isNull(), F.lit(defaults[path]).cast(dtype)).otherwise(plain) if path in defaults else plain
        if isinstance(dtype, (DoubleType, LongType)):
            return _number(value, dtype)
        if isinstance(dtype, StructType):
            return F.when(value.isNotNull(), F.struct(*[
                cast(value.getField(f.name), f.dataType, read[f.name].dataType, f"{path}.{f.name}".lstrip(".")).alias(f.name)
                for f in dtype.fields]))
        if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, (StructType, DoubleType, LongType)):
            return F.transform(value, lambda e: cast(e, dtype.elementType, read.elementType, f"{path}[]"))
        return value.cast(dtype)

    fields = []
    for f in schemas.ENTITIES[entity].fields:
        value = record.getField(f.name)
        if f.name in schemas.TIMESTAMPS[entity]:
            column = value.try_cast("timestamp_ntz")
        else:
            column = cast(value, f.dataType, _record_schema(entity)[f.name].dataType, f.name)
            if f.name in EMPTY_WHERE_MISSING:
                column = F.coalesce(column, F.array().cast(f.dataType))
        fields.append(column.alias(f.name))
    return F.struct(*fields)


def classify(pages: DataFrame, entity: str) -> DataFrame:
    """source_file, outcome, r (the typed record), record, reasons, message:
    one row for each record, and for each page without readable ones.  A
    page with an empty ``data``, or none, has nothing to tell and no row."""
    record = _record_schema(entity)
    entry = f"array<struct<r:{record.simpleString()},text:string,message:string>>"
    error, text = F.col("error"), F.col("_unreadable")
    # Only marked pages are parsed again, into the texts of their records.
    again = F.from_json(text, "data array<string>, error string, _fault string", {"columnNameOfCorruptRecord": FAULT})
    parse = lambda t: F.from_json(t, record, {"columnNameOfCorruptRecord": FAULT})
    apart = F.transform(again["data"], lambda t: F.struct(parse(t).alias("r"), t.alias("text"), F.lit(None).cast("string").alias("message")))
    whole = F.transform("data", lambda r: F.struct(r.alias("r"), F.lit(None).cast("string").alias("text"),
                                                   F.lit(None).cast("string").alias("message")))
    lost = F.array(F.struct(F.lit(None).cast(record).alias("r"), F.lit(None).cast("string").alias("text"),
                            F.coalesce(error, F.concat(F.lit("unreadable page: "), text)).alias("message")))
    entries = (F.when(error.isNotNull(), lost).when(text.isNull(), whole)
               .when(again[FAULT].isNull() & again["data"].isNotNull(), apart).otherwise(lost)).cast(entry)
    rows = pages.select("source_file", F.explode(entries).alias("e")).select("source_file", "e.r", "e.text", "e.message")
    found = rows.withColumn("reasons", F.when(F.col("message").isNull(), reasons(F.col("r"), entity)))
    outcome = (F.when(F.col("message").isNotNull(), "page").when(F.size("reasons") == 0, "valid").otherwise("reject"))
    shown = F.coalesce("text", F.to_json(F.struct(*[F.col("r").getField(f.name).alias(f.name) for f in record.fields if f.name != FAULT])))
    return found.select(
        "source_file", outcome.alias("outcome"), F.when(outcome == "valid", typed(F.col("r"), entity)).alias("r"),
        F.when(outcome == "reject", F.when(F.col("r").isNull() & F.col("text").isNull(), "null").otherwise(shown)).alias("record"),
        F.when(outcome == "reject", F.col("reasons")).alias("reasons"), "message")


def outcomes(staged: DataFrame, entity: str, all_or_nothing: bool = False) -> Intake:
    """The three results of a staged table.  ``all_or_nothing=True``: a
    page file with a reject or a lost page has no valid records; its good
    ones then stay in the staged table only."""
    valid, rejects, pages = (staged.where(F.col("outcome") == name) for name in ("valid", "reject", "page"))
    if all_or_nothing:
        bad = staged.where(F.col("outcome") != "valid").select("source_file").distinct()
        valid = valid.join(bad, "source_file", "left_anti")
    fields = [F.col("r").getField(f.name).alias(f.name) for f in schemas.ENTITIES[entity].fields]
    return Intake(valid.select("source_file", *fields), rejects.select("source_file", "record", "reasons"),
                  pages.select("source_file", "message"))


def take_in(spark: SparkSession, path: str, entity: str, stage_path: str | None = None, multi_line: bool = False,
            all_or_nothing: bool = False) -> Intake:
    """Reads the pages under ``path`` once, writes every outcome to
    ``stage_path`` (by default in the shared folder) and returns the three
    results."""
    stage_path = stage_path or scratch_path(spark, f"intake-{uuid.uuid4().hex}")
    found = classify(read_envelopes(spark, path, entity, multi_line), entity)
    found.write.parquet(stage_path)
    return outcomes(spark.read.schema(found.schema).parquet(stage_path), entity, all_or_nothing)
