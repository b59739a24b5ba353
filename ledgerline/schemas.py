"""Declared schemas of the billing API records and of the page envelope.

Ids are strings, amounts are doubles as the API sends them, and
timestamps arrive as text (a validated read types them, see
``TIMESTAMPS``).  ``REQUIRED`` lists, per entity, the fields a record
must carry with a non-null value to be valid.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DataType, DoubleType, LongType, MapType,
                               StringType, StructField, StructType, VariantType)

S = StringType()
D = DoubleType()
L = LongType()
STR_MAP = MapType(S, S)


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CREDIT_TYPE = _struct(("id", S), ("name", S))

CUSTOMER = _struct(
    ("id", S), ("name", S), ("external_id", S), ("ingest_aliases", ArrayType(S)),
    ("custom_fields", STR_MAP), ("customer_config", STR_MAP))

SUB_LINE_ITEM = _struct(
    ("charge_id", S), ("name", S), ("subtotal", D), ("price", D), ("quantity", D),
    ("custom_fields", STR_MAP))

LINE_ITEM = _struct(
    ("total", D), ("credit_type", CREDIT_TYPE), ("name", S), ("product_id", S), ("quantity", D),
    ("custom_fields", STR_MAP), ("sub_line_items", ArrayType(SUB_LINE_ITEM)))

INVOICE_ADJUSTMENT = _struct(("total", D), ("credit_type", CREDIT_TYPE))

INVOICE = _struct(
    ("id", S), ("customer_id", S), ("start_timestamp", S), ("end_timestamp", S), ("type", S),
    ("status", S), ("billable_status", S), ("plan_id", S), ("plan_name", S), ("total", D),
    ("subtotal", D), ("external_invoice", S), ("credit_type", CREDIT_TYPE),
    ("customer_custom_fields", STR_MAP), ("plan_custom_fields", STR_MAP), ("custom_fields", STR_MAP),
    ("line_items", ArrayType(LINE_ITEM)), ("invoice_adjustments", ArrayType(INVOICE_ADJUSTMENT)))

AMOUNT = _struct(("amount", D), ("credit_type", CREDIT_TYPE))
BALANCE = _struct(("including_pending", L), ("excluding_pending", L), ("effective_at", S))
DEDUCTION = _struct(
    ("amount", D), ("reason", S), ("running_balance", D), ("effective_at", S), ("created_by", S),
    ("credit_grant_id", S), ("invoice_id", S))

CREDIT_GRANT = _struct(
    ("id", S), ("name", S), ("customer_id", S), ("uniqueness_key", S), ("reason", S),
    ("effective_at", S), ("expires_at", S), ("priority", D), ("grant_amount", AMOUNT),
    ("paid_amount", AMOUNT), ("balance", BALANCE), ("deductions", ArrayType(DEDUCTION)),
    ("pending_deductions", ArrayType(DEDUCTION)), ("custom_fields", _struct(("x_account_id", S))),
    ("credit_grant_type", S))

def _under(path: str, names: list[str]) -> list[str]:
    return [path] + [f"{path}.{n}" for n in names]


def _each(path: str, names: list[str]) -> list[str]:
    """The array, its elements, and ``names`` in each element."""
    return [path] + _under(f"{path}[]", names)


_CREDIT_TYPE = _under("credit_type", ["id", "name"])
_SUB_LINE = ["charge_id", "name", "subtotal", "price", "quantity", "custom_fields"]
_LINE = ["total", *_CREDIT_TYPE, "name", "product_id", "quantity", "custom_fields", *_each("sub_line_items", _SUB_LINE)]
_DEDUCTION = ["amount", "reason", "running_balance", "effective_at", "created_by", "credit_grant_id"]

# Fields that must be present and non-null for a record to be valid.  A
# nested field is required wherever its parent is there; ``[]`` means
# every element of an array.
REQUIRED = {
    "customer": ["id", "name", *_each("ingest_aliases", []), "custom_fields", "customer_config"],
    "invoice": ["id", "customer_id", "start_timestamp", "end_timestamp", "type", "status",
                "billable_status", "plan_id", "plan_name", "total", "subtotal", *_CREDIT_TYPE,
                "customer_custom_fields", "plan_custom_fields", "custom_fields", *_each("line_items", _LINE),
                *_each("invoice_adjustments", ["total", *_CREDIT_TYPE])],
    "credit_grant": ["id", "name", "customer_id", "effective_at", "expires_at", "priority",
                     *_under("grant_amount", ["amount", *_CREDIT_TYPE]),
                     *_under("paid_amount", ["amount", *_CREDIT_TYPE]), *_under("balance", ["effective_at"]),
                     *_each("deductions", _DEDUCTION),
                     *[n for n in _each("pending_deductions", _DEDUCTION) if n != "pending_deductions"]],
}

# Fields that must be present but may be null, and numbers that have a
# value where they are missing (null stays null there).
PRESENT = {
    "customer": ["external_id"],
    "invoice": ["external_invoice"],
    "credit_grant": ["reason", "deductions[].invoice_id", "pending_deductions[].invoice_id"],
}
DEFAULTS = {
    "customer": {},
    "invoice": {},
    "credit_grant": {"balance.including_pending": 0, "balance.excluding_pending": 0},
}

# Text fields holding timestamps; a validated read types them as
# ``timestamp_ntz`` (wall-clock time as written) and rejects bad text.
TIMESTAMPS = {
    "customer": [],
    "invoice": ["start_timestamp", "end_timestamp"],
    "credit_grant": ["effective_at", "expires_at"],
}

ENTITIES = {"customer": CUSTOMER, "invoice": INVOICE, "credit_grant": CREDIT_GRANT}


def page_schema(record: DataType, single: bool = False) -> StructType:
    """Envelope ``{"data": [...], "next_page": ..., "error": ...}``.

    ``single=True`` is the one-object form (``data`` is an object).
    """
    data_type = record if single else ArrayType(record)
    return _struct(("data", data_type), ("next_page", S), ("error", S))


def as_text_leaves(dtype: DataType) -> DataType:
    """Same shape with every numeric leaf read as string.

    Reading numbers as text keeps a bad value (``"12.5x"``) visible so
    the record can be rejected with a reason instead of silently
    becoming null.
    """
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, as_text_leaves(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(as_text_leaves(dtype.elementType), True)
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, as_text_leaves(dtype.valueType), True)
    if isinstance(dtype, (DoubleType, LongType)):
        return StringType()
    return dtype


def reading_schema(entity: str) -> StructType:
    """Text leaves, and a variant for each field of ``PRESENT`` and
    ``DEFAULTS``: the one type in which a JSON null (a variant null) and a
    missing field (null) differ, in the same parse."""
    told_apart = {p.replace("[]", "") for p in [*PRESENT[entity], *DEFAULTS[entity]]}

    def read(dtype: DataType, path: str) -> DataType:
        if path in told_apart:
            return VariantType()
        if isinstance(dtype, StructType):
            return StructType([StructField(f.name, read(f.dataType, f"{path}.{f.name}".lstrip(".")), True)
                               for f in dtype.fields])
        if isinstance(dtype, ArrayType):
            return ArrayType(read(dtype.elementType, path), True)
        return as_text_leaves(dtype)

    return read(ENTITIES[entity], "")
