"""Union of record sources whose schemas differ.

``merge_schemas`` finds the narrowest schema that holds every source:
columns are the union of all, in order of first appearance, and a field
that sources type differently takes a type both fit in.

* null with anything: the other type;
* integers: the larger; integer with decimal: a decimal with room for
  both; any number with float or double: double;
* date with timestamp: timestamp; a timestamp with and one without zone:
  without (the wall-clock time of the session);
* structs field by field, arrays by element, maps by value;
* anything else (a number with a text, a struct with a scalar): text,
  nested values as JSON text.

``union_widened`` casts every source to it and appends them, duplicates
kept.  All of it is metadata and projections: no pass over the data, no
shuffle, and any number of sources.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

INTEGERS = (ByteType, ShortType, IntegerType, LongType)      # narrow to wide
INTEGER_DIGITS = (3, 5, 10, 20)
_NESTED = (StructType, ArrayType, MapType)


def _as_decimal(kind: DataType) -> DecimalType:
    return kind if isinstance(kind, DecimalType) else DecimalType(INTEGER_DIGITS[INTEGERS.index(type(kind))], 0)


def widest(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas([a, b])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, widest(a.valueType, b.valueType))
    exact = (*INTEGERS, DecimalType)
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return max(a, b, key=lambda t: INTEGERS.index(type(t)))
    if isinstance(a, exact) and isinstance(b, exact):
        x, y = _as_decimal(a), _as_decimal(b)
        scale, whole = max(x.scale, y.scale), max(x.precision - x.scale, y.precision - y.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    numbers = (*exact, FloatType, DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return DoubleType()
    times = (DateType, TimestampType, TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        zoned = {type(a), type(b)} == {DateType, TimestampType}
        return TimestampType() if zoned else TimestampNTZType()
    return StringType()


def merge_schemas(schemas: list[StructType]) -> StructType:
    """One schema for all; names are compared as written."""

    def both(a: StructType, b: StructType) -> StructType:
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = widest(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return StructType([StructField(n, t) for n, t in fields.items()])

    return reduce(both, schemas, StructType())


def _widen(value: Column, have: DataType, want: DataType) -> Column:
    if have == want:
        return value
    if isinstance(have, NullType):
        return F.lit(None).cast(want)
    if isinstance(want, StringType) and isinstance(have, _NESTED):
        return F.to_json(value)
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(_widen(value.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType))
                  .alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: _widen(x, have.elementType, want.elementType))
    if isinstance(have, MapType) and isinstance(want, MapType):
        return F.transform_values(value, lambda _, x: _widen(x, have.valueType, want.valueType))
    return value.cast(want)


def widened(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame in the merged schema; columns it lacks are null."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(_widen(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema.fields])


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames in one schema."""
    schema = merge_schemas([df.schema for df in frames])
    return reduce(DataFrame.unionByName, [widened(df, schema) for df in frames])
