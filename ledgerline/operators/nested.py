"""Flattening nested records.

``flatten_wide`` turns nested records into one wide row each, naming
columns ``parent_child`` and ``list_0_child``:

* a struct's fields join their names with ``sep``; an empty struct or
  map gives no column;
* array elements get their index; struct (and map) elements are
  flattened further, an array directly inside an array is kept whole;
* map keys (text) become name parts, and lists and records held in a map
  are flattened like any other; the keys come from the data;
* when two paths produce the same name the later one wins, in the
  position of the first.

The width depends on the data, so it takes one pass for the shape and
then a single projection (no shuffle of records).  The shape holds the
length of the array, or the keys of the map, at each concrete position
(``line_items``, ``line_items_0_sub_line_items``, ...), so there is a
column exactly for each position that some record has.

The shape is a table (``shape_table``) that merges: landed data keeps the
shape of each part beside it (``land_part``), and the shape of all parts
is a merge of these small tables instead of a pass over the records.
What reaches the driver is bounded: the ``MOST_ENTRIES`` containers and
map keys that most records have, and ``MOST_ITEMS`` positions an array.
Data beyond that (open-ended map keys, say) has a shape that is ``cut``:
``flatten_wide`` then asks for ``allow_cut=True`` and gives the columns
of the shape, and ``flatten_rest`` gives every other leaf in the long
form, so both together are whole.

``flatten_long`` gives the same leaves as rows (name, value) in one
pass: no shape, and no width.  ``explode_lines`` is the long form of
invoices with typed columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

_NESTED = (StructType, MapType)
_CONTAINERS = "array<struct<path:array<string>,key:string,size:int>>"
_LEAVES = "array<struct<name:string,value:string>>"


def _or_none(entries: Column, kind: str) -> Column:
    return F.coalesce(entries, F.array().cast(kind))


def _join(parts: list[Column], kind: str) -> Column:
    return F.concat(*parts) if parts else F.array().cast(kind)


def _containers(dtype: DataType, value: Column, path: Column) -> list[Column]:
    """Arrays of (path, key, size): the size of each array and the keys
    of each map in ``value``, at their concrete positions."""

    def inside(child: DataType, child_value: Column, step: Column) -> Column:
        return _join(_containers(child, child_value, F.concat(path, F.array(step))), _CONTAINERS)

    out = []
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            out += _containers(f.dataType, value.getField(f.name), F.concat(path, F.array(F.lit(f.name))))
    elif isinstance(dtype, ArrayType):
        out.append(F.array(F.struct(path.alias("path"), F.lit(None).cast("string").alias("key"),
                                    F.size(value).alias("size"))))
        if isinstance(dtype.elementType, _NESTED):
            out.append(F.flatten(F.transform(value, lambda x, i: inside(dtype.elementType, x, i.cast("string")))))
    elif isinstance(dtype, MapType):
        out.append(F.transform(F.map_keys(value), lambda k: F.struct(
            path.alias("path"), k.alias("key"), F.lit(None).cast("int").alias("size"))))
        if isinstance(dtype.valueType, (*_NESTED, ArrayType)):
            out.append(F.flatten(F.transform(F.map_entries(value), lambda e: inside(
                dtype.valueType, e.getField("value"), e.getField("key")))))
    return out if isinstance(dtype, StructType) else [_or_none(c, _CONTAINERS) for c in out]


MOST_ENTRIES, MOST_ITEMS = 20_000, 1_000


class Shape(NamedTuple):
    """Length of each array and keys of each map by concrete position (a
    tuple of names, indexes and keys); whether the data has more."""

    sizes: dict
    keys: dict
    cut: bool = False


def shape_table(df: DataFrame) -> DataFrame:
    """(path, key, size, n): each array position with its longest length,
    each map key, and how many records have it.  One pass, combined in
    the tasks."""
    found = []
    for f in df.schema.fields:
        found += _containers(f.dataType, F.col(f"`{f.name}`"), F.array(F.lit(f.name)))
    entries = df.select(F.explode(_join(found, _CONTAINERS)).alias("e")).select("e.*")
    return entries.groupBy("path", "key").agg(F.max("size").alias("size"), F.count("*").alias("n"))


def merge_shapes(tables: DataFrame) -> DataFrame:
    """One shape table of the union of several."""
    return tables.groupBy("path", "key").agg(F.max("size").alias("size"), F.sum("n").alias("n"))


def read_shape(table: DataFrame, most_entries: int = MOST_ENTRIES, most_items: int = MOST_ITEMS) -> Shape:
    """The part of a shape table that makes columns."""
    order = [F.col("n").desc(), F.size("path"), F.array_join("path", "\0"), "key"]
    rows = table.orderBy(*order).limit(most_entries + 1).collect()
    cut = len(rows) > most_entries
    # A container counts only if the map keys on its path do.
    kept: set = set()
    sizes: dict = {}
    keys: dict = {}
    maps = {tuple(r["path"]) for r in rows if r["key"] is not None}
    for r in sorted(rows[:most_entries], key=lambda r: len(r["path"])):
        path = tuple(r["path"])
        if any(path[:n] in maps and (path[:n], path[n]) not in kept for n in range(1, len(path))):
            cut = True
        elif r["key"] is None:
            size = max(r["size"] or 0, 0)
            cut |= size > most_items
            sizes[path] = min(size, most_items)
        else:
            kept.add((path, r["key"]))
            keys.setdefault(path, []).append(r["key"])
    return Shape(sizes, {p: sorted(k) for p, k in keys.items()}, cut)


def flatten_shape(df: DataFrame, most_entries: int = MOST_ENTRIES, most_items: int = MOST_ITEMS) -> Shape:
    """The shape of records without a stored one: one pass."""
    return read_shape(shape_table(df), most_entries, most_items)


def _shape_folder(path: str, part: str = "") -> str:
    return f"{path.rstrip('/')}-shape{part}"


def land_part(df: DataFrame, path: str, part: str) -> None:
    """Writes records as part ``part`` of ``path``, and their shape beside
    it; a part that lands again replaces its earlier self."""
    folder = f"/part={part}"
    df.write.mode("overwrite").parquet(path.rstrip("/") + folder)
    written = df.sparkSession.read.schema(df.schema).parquet(path.rstrip("/") + folder)
    shape_table(written).write.mode("overwrite").parquet(_shape_folder(path, folder))


def landed_shape(spark: SparkSession, path: str, most_entries: int = MOST_ENTRIES, most_items: int = MOST_ITEMS) -> Shape:
    """The shape of all landed parts, from their shape tables."""
    tables = spark.read.schema("path array<string>, key string, size int, n long").parquet(_shape_folder(path))
    return read_shape(merge_shapes(tables), most_entries, most_items)


def _project(dtype: DataType, path: tuple, value: Column, sep: str, sizes: dict, keys: dict, out: list) -> None:
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            _project(f.dataType, (*path, f.name), value.getField(f.name), sep, sizes, keys, out)
    elif isinstance(dtype, ArrayType):
        for i in range(sizes.get(path, 0)):
            _element(dtype.elementType, (*path, str(i)), F.get(value, i), sep, sizes, keys, out)
    elif isinstance(dtype, MapType):
        for k in keys.get(path, []):
            _project(dtype.valueType, (*path, k), value.getItem(k), sep, sizes, keys, out)
    else:
        out.append((sep.join(path), value))


def _element(dtype: DataType, path: tuple, value: Column, sep: str, sizes: dict, keys: dict, out: list) -> None:
    if isinstance(dtype, ArrayType):
        out.append((sep.join(path), value))
    else:
        _project(dtype, path, value, sep, sizes, keys, out)


def flat_columns(schema: StructType, shape: Shape, sep: str = "_", root: Column | None = None) -> dict[str, Column]:
    """Name -> expression of the wide row's columns; ``root``: the struct
    that holds the record, if it isn't the row itself."""
    out: list = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`") if root is None else root.getField(f.name)
        _project(f.dataType, (f.name,), value, sep, shape.sizes, shape.keys, out)
    order: dict = {}
    for n, c in out:
        order[n] = c          # later name wins, first position kept
    return order


def flatten_wide(df: DataFrame, sep: str = "_", shape: Shape | None = None, allow_cut: bool = False) -> DataFrame:
    """Nested records to one wide row each (see module doc)."""
    shape = shape or flatten_shape(df)
    if shape.cut and not allow_cut:
        raise ValueError("the records have more positions or map keys than columns are made for; pass allow_cut=True "
                         "and take the rest with flatten_rest")
    return df.select(*[c.alias(n) for n, c in flat_columns(df.schema, shape, sep).items()])


def flatten_rest(df: DataFrame, keep: list[str], shape: Shape, sep: str = "_") -> DataFrame:
    """The leaves that a cut shape has no column for, in the long form."""
    columns = list(flat_columns(df.schema, shape, sep))
    long = flatten_long(df, keep, sep)
    return long.where(~F.col("name").isin(columns)) if columns else long


def _leaves(dtype: DataType, value: Column, name: Column, sep: str) -> list[Column]:
    """Arrays of (name, value) of the leaves of ``value``."""

    def inside(child: DataType, child_value: Column, step: Column) -> Column:
        child_name = F.concat(name, F.lit(sep), step)
        if isinstance(child, ArrayType) and isinstance(dtype, ArrayType):
            return F.array(F.struct(child_name.alias("name"), F.to_json(child_value).alias("value")))
        return _join(_leaves(child, child_value, child_name, sep), _LEAVES)

    if isinstance(dtype, StructType):
        return [c for f in dtype.fields
                for c in _leaves(f.dataType, value.getField(f.name), F.concat(name, F.lit(sep + f.name)), sep)]
    if isinstance(dtype, ArrayType):
        each = F.flatten(F.transform(value, lambda x, i: inside(dtype.elementType, x, i.cast("string"))))
        return [_or_none(each, _LEAVES)]
    if isinstance(dtype, MapType):
        each = F.flatten(F.transform(F.map_entries(value), lambda e: inside(
            dtype.valueType, e.getField("value"), e.getField("key"))))
        return [_or_none(each, _LEAVES)]
    return [F.array(F.struct(name.alias("name"), value.cast("string").alias("value")))]


def flatten_long(df: DataFrame, keep: list[str], sep: str = "_") -> DataFrame:
    """One row (``keep`` columns, name, value as text) for each leaf that
    isn't null; names as in ``flatten_wide``, an array inside an array as
    JSON text.  Narrow; two paths of one name give two rows."""
    found = []
    for f in df.schema.fields:
        if f.name not in keep:
            found += _leaves(f.dataType, F.col(f"`{f.name}`"), F.lit(f.name), sep)
    leaves = df.select(*keep, F.explode(_join(found, _LEAVES)).alias("__leaf"))
    return leaves.select(*keep, "__leaf.name", "__leaf.value").where(F.col("value").isNotNull())


def explode_lines(invoices: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Long form: one row per (invoice, line item, sub-line item).

    ``posexplode_outer`` twice; invoices without lines and lines without
    sub-lines are kept with null positions.  Runs row by row inside the
    scan stage (no shuffle).
    """
    keep = keep or ["id", "customer_id", "status", "end_timestamp"]
    lines = invoices.select(*keep, F.posexplode_outer("line_items").alias("line_index", "line"))
    subs = lines.select(*keep, "line_index", "line",
                        F.posexplode_outer("line.sub_line_items").alias("sub_index", "sub"))
    return subs.select(
        *keep, "line_index",
        F.col("line.name").alias("line_name"), F.col("line.product_id").alias("product_id"),
        F.col("line.quantity").alias("line_quantity"), F.col("line.total").alias("line_total"),
        "sub_index",
        F.col("sub.charge_id").alias("charge_id"), F.col("sub.name").alias("sub_name"),
        F.col("sub.quantity").alias("sub_quantity"), F.col("sub.subtotal").alias("sub_subtotal"),
        F.col("sub.price").alias("sub_price"))
