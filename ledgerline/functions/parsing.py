"""Text-to-structure expressions: key-value text, Python-dict text, JSON.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen and let filters be pushed below them; none is a
Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerline.functions.common import as_col

# Fixed format of the key-value text: ``{k=v, k2=v2}``.
KV_PAIR_SEPARATOR = ", "
KV_KEY_SEPARATOR = "="


def kv_body(text) -> Column:
    """The text between the outer braces of ``{k=v, k2=v2}``."""
    return F.regexp_replace(as_col(text), r"^[{]|[}]$", "")


def kv_to_map(text) -> Column:
    """``{k=v, k2=v2}`` as ``map<string,string>``.

    Spark's ``str_to_map`` raises on a repeated key (the default
    ``mapKeyDedupPolicy``); use :func:`kv_get` on untrusted text, which
    takes the first occurrence.
    """
    return F.when(as_col(text).isNotNull(),
                  F.str_to_map(kv_body(text), F.lit(KV_PAIR_SEPARATOR), F.lit(KV_KEY_SEPARATOR)))


def kv_get(text, key: str) -> Column:
    """Value of ``key`` in ``{k=v, k2=v2}``; first occurrence wins.

    The key is the text before the first ``=`` of a pair and the value
    is everything after it, so ``{a=b=c}`` gives ``b=c`` for ``a``.  A
    value holding ``", "`` is cut at that separator, and a piece without
    ``=`` is not a pair.  Missing key gives null.
    """
    pairs = F.split(kv_body(text), KV_PAIR_SEPARATOR)
    hit = F.get(F.filter(pairs, lambda p: (F.instr(p, KV_KEY_SEPARATOR) > 0) &
                         (F.substring_index(p, KV_KEY_SEPARATOR, 1) == F.lit(key))), 0)
    return F.substr(hit, F.instr(hit, KV_KEY_SEPARATOR) + 1)


def pydict_text_to_json(text) -> Column:
    """Python ``repr`` dict/list text to JSON text.

    Single quotes are accepted by the JSON reader as they are (also
    mixed with double quotes around strings holding an apostrophe); only
    the bare ``None``/``True``/``False`` tokens need rewriting.  Tokens
    inside quoted strings are left alone because the rewrite only fires
    after ``:``, ``[`` or ``,`` and before ``,``, ``}`` or ``]``.
    """
    t = as_col(text)
    t = F.regexp_replace(t, r"(?<=[:\[,]\s?)None(?=\s*[,}\]])", "null")
    t = F.regexp_replace(t, r"(?<=[:\[,]\s?)True(?=\s*[,}\]])", "true")
    t = F.regexp_replace(t, r"(?<=[:\[,]\s?)False(?=\s*[,}\]])", "false")
    return t


def pydict_to_struct(text, schema: DataType | str) -> Column:
    """Parse Python-dict text (``{'a': 1, 'b': None}``) with a schema."""
    return F.from_json(pydict_text_to_json(text), schema, {"allowSingleQuotes": "true"})


def json_parse(text, schema: DataType | str) -> Column:
    """JSON text to a typed struct/array; malformed text gives null."""
    return F.from_json(as_col(text), schema)


def json_path(text, path: str) -> Column:
    """Scalar at a JSON path as plain text (no quotes kept).

    A JSON ``null`` and a missing key both give SQL null.
    """
    return F.get_json_object(as_col(text), path)


def json_array_first(array_or_text, field: str) -> Column:
    """``field`` of the first element of an array; null when empty.

    Works on a typed ``array<struct>`` column (``get`` is null out of
    range even under ANSI mode, unlike ``arr[0]``) or on a column name
    holding JSON text.
    """
    c = as_col(array_or_text)
    # ``arr.field`` then element 0: same value as ``arr[0].field``, and it
    # lets the parquet reader fetch only that nested field.
    return F.get(c.getField(field), 0)


def json_text_array_first(text, field: str) -> Column:
    """``field`` of element 0 of a JSON array held as text."""
    return F.get_json_object(as_col(text), f"$[0].{field}")


def cast_strict(value, to: str) -> Column:
    """Cast that raises on bad input (ANSI)."""
    return as_col(value).cast(to)


def cast_lenient(value, to: str) -> Column:
    """Cast that gives null on bad input."""
    return as_col(value).try_cast(to)


def to_int_rounded(value) -> Column:
    """Round a double before narrowing it, so 2.7 becomes 3, not 2."""
    return F.round(as_col(value).cast("double"), 0).cast("bigint")
