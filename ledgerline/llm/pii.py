"""Format-preserving pseudonyms for personal data, with built-in
functions only.

One pass of a regular expression finds candidates; each kind has its
check (Luhn digit, octet range, calendar date, number blocks) and what
fails it stays as it is.  A validated value is permuted within its
format by a keyed Feistel network, so equal values get equal pseudonyms
in every document, and different values different ones:

* numbers with parts (phone, social security number, IPv4 address, date)
  are coordinates (x, y, z); each round adds a keyed hash of two of them
  to the third, modulo its range.  Dates are days of their century, whose
  number is the product of two such ranges; so is that of days above 12.
* strings (mail names, card digits, keys) are two halves; each round adds
  a keyed hash of one half to the other, character by character, within
  a character's class (digit, lower, upper).  A card's first digit stays
  and its check digit is computed anew.

Each written form has a permutation of its own, so no two forms share a
pseudonym: a date written with slashes is day first if it can be, and the
others, month first with a day above 12, are permuted among themselves.

Every row is handled by itself: no shuffle, nothing to the driver, no
Python.  Whoever runs it in earnest passes a secret ``key``.

Defined results.  Null text: null, 0 replaced.  Empty text: empty.
Very long texts are handled whole.  A null id stays null.  Repeated rows
give repeated results; an empty table gives none.  Overlaps: the leftmost
candidate wins, at one place the first kind of ``KINDS``.  Columns other
than the text are passed through (``pseudonymize``) or not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.joins import unused

DEFAULT_KEY = "replace-with-a-secret"
ROUNDS = 12

# Kind -> pattern (Java).  Only character classes are repeated without
# bound, so long texts need no deep recursion.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"""(?i:(?<![a-z])(?:password|passwd|secret|token|api_key))\s{0,4}[=:]\s{0,4}["']?[A-Za-z0-9]{12,}""",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?\d{3}[ .-]|\d{3}[.-]\d{3}[.-])\d{4}(?![\d.-]*\d)",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![/-]?\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}

# What every candidate has a part of: all numbers but IPv4 addresses have
# two digits in a row.
_MAY_HOLD = r"[0-9][0-9]|[0-9]\.[0-9]|@|AKIA|(?i:passw|secret|token|api_key)"


def _pattern() -> str:
    numbered = []
    for kind, p in KINDS.items():
        numbered.append(p.replace(r"\1", r"\k<sep>").replace("([ -])", "(?<sep>[ -])") if kind == "card" else p)
    return "|".join(f"(?:{p})" for p in numbered)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number_feistel(kind: str, key: str, parts: list[tuple[str, str]], result) -> str:
    """SQL: permutes coordinates (value, range) and hands the new ones'
    names to ``result``."""
    values = [*parts, *[("0L", "1L")] * (3 - len(parts))]
    start = ", ".join(f"CAST({v} AS BIGINT) AS p{n}, CAST({m} AS BIGINT) AS m{n}" for n, (v, m) in enumerate(values))

    def turn(n: int) -> str:
        others = ", '|', ".join(f"s.p{i}" for i in range(3) if i != n)
        hashed = f"conv(substr(sha2(concat({_text(f'{key}|{kind}|')}, i, '|', {others}), 256), 1, 14), 16, 10)"
        return f"IF(i % 3 = {n}, (s.p{n} + CAST({hashed} AS BIGINT)) % s.m{n}, s.p{n}) AS p{n}, s.m{n} AS m{n}"

    step = "struct(" + ", ".join(turn(n) for n in range(3)) + ")"
    return (f"aggregate(sequence(0, {ROUNDS - 1}), struct({start}), (s, i) -> {step}, "
            f"s -> {result('s.p0', 's.p1', 's.p2')})")


def _string_feistel(kind: str, key: str, value: str) -> str:
    """SQL: permutes a string within its characters' classes."""
    half = f"CAST(floor(length({value}) / 2) AS INT)"
    start = f"struct(substr({value}, 1, {half}) AS a, substr({value}, {half} + 1) AS b)"

    def added(x: str, other: str) -> str:
        stream = f"sha2(concat({_text(f'{key}|{kind}|')}, i, '|', {other}), 256)"
        amount = "CAST(conv(substr(h, 2 * ((p - 1) % 32) + 1, 2), 16, 10) AS INT)"
        c = f"substr({x}, p, 1)"
        char = (f"CASE WHEN {c} BETWEEN '0' AND '9' THEN chr(48 + (ascii({c}) - 48 + {amount}) % 10) "
                f"WHEN {c} BETWEEN 'a' AND 'z' THEN chr(97 + (ascii({c}) - 97 + {amount}) % 26) "
                f"WHEN {c} BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii({c}) - 65 + {amount}) % 26) ELSE {c} END")
        # A one-element array binds the hash to a name.
        each = f"transform(array({stream}), h -> array_join(transform(sequence(1, length({x})), p -> {char}), ''))[0]"
        return f"IF(length({x}) = 0, '', {each})"

    step = (f"struct(IF(i % 2 = 0, {added('s.a', 's.b')}, s.a) AS a, "
            f"IF(i % 2 = 1, {added('s.b', 's.a')}, s.b) AS b)")
    return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, i) -> {step}, s -> concat(s.a, s.b))"


def _luhn(digits: str) -> str:
    """SQL: the sum whose last digit is 0 for a valid number."""
    d = f"CAST(substr({digits}, length({digits}) - i, 1) AS INT)"
    return (f"aggregate(sequence(0, length({digits}) - 1), 0, (t, i) -> t + IF(i % 2 = 0, {d}, "
            f"IF({d} > 4, 2 * {d} - 9, 2 * {d})))")


def _fill(shape: str, digits: str) -> str:
    """SQL: the digits put in place of those of ``shape``, in order."""
    c = f"substr({shape}, p, 1)"
    nth = f"length(regexp_replace(substr({shape}, 1, p), '[^0-9]', ''))"
    return (f"array_join(transform(sequence(1, length({shape})), p -> "
            f"IF({c} BETWEEN '0' AND '9', substr({digits}, {nth}, 1), {c})), '')")


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _email(key: str) -> str:
    return f"concat({_string_feistel('email', key, 'substring_index(m, \'@\', 1)')}, '@', substring_index(m, '@', -1))"


def _key(key: str) -> str:
    return f"concat('AKIA', {_string_feistel('key', key, 'substr(m, 5)')})"


def _secret(key: str) -> str:
    body = (f"IF(v RLIKE '[0-9]' AND v RLIKE '[A-Za-z]', "
            f"concat(substr(m, 1, length(m) - length(v)), {_string_feistel('secret', key, 'v')}), m)")
    return _let("regexp_extract(m, '[A-Za-z0-9]+$', 0)", "v", body)


def _phone(key: str) -> str:
    # Ten digits after an optional country code.  A block that starts with
    # 2 to 9 keeps doing so.
    def block(at: int) -> tuple[str, str]:
        n = f"CAST(substr(d, {at}, 3) AS INT)"
        return f"IF({n} >= 200, {n} - 200, {n})", f"IF({n} >= 200, 800, 200)"

    def back(x: str, y: str, z: str) -> str:
        def shown(v: str, at: int) -> str:
            return f"lpad(CAST({v} + IF(CAST(substr(d, {at}, 3) AS INT) >= 200, 200, 0) AS STRING), 3, '0')"

        return f"concat({shown(x, 1)}, {shown(y, 4)}, lpad(CAST({z} AS STRING), 4, '0'))"

    permuted = _number_feistel("phone", key, [block(1), block(4), ("CAST(substr(d, 7, 4) AS INT)", "10000")], back)
    whole = _let("right(regexp_replace(m, '[^0-9]', ''), 10)", "d", _let(
        f"concat(substr(regexp_replace(m, '[^0-9]', ''), 1, length(regexp_replace(m, '[^0-9]', '')) - 10), {permuted})",
        "e", _fill("m", "e")))
    return whole


def _ip(key: str) -> str:
    octet = [f"CAST(split(m, '[.]')[{n}] AS INT)" for n in range(4)]

    def back(x: str, y: str, _: str) -> str:
        return f"concat_ws('.', {x} DIV 256, {x} % 256, {y} DIV 256, {y} % 256)"

    permuted = _number_feistel("ip", key, [(f"{octet[0]} * 256 + {octet[1]}", "65536"),
                                           (f"{octet[2]} * 256 + {octet[3]}", "65536")], back)
    return f"IF(array_max(transform(split(m, '[.]'), o -> CAST(o AS INT))) <= 255, {permuted}, m)"


def _ssn(key: str) -> str:
    area, group, serial = "CAST(substr(m, 1, 3) AS INT)", "CAST(substr(m, 5, 2) AS INT)", "CAST(substr(m, 8, 4) AS INT)"

    def back(x: str, y: str, z: str) -> str:
        shown = f"IF({x} + 1 >= 666, {x} + 2, {x} + 1)"
        return (f"concat(lpad(CAST({shown} AS STRING), 3, '0'), '-', lpad(CAST({y} + 1 AS STRING), 2, '0'), '-', "
                f"lpad(CAST({z} + 1 AS STRING), 4, '0'))")

    permuted = _number_feistel("ssn", key, [(f"IF({area} > 666, {area} - 2, {area} - 1)", "898"),
                                            (f"{group} - 1", "99"), (f"{serial} - 1", "9999")], back)
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    return f"IF({valid}, {permuted}, m)"


def _date(key: str) -> str:
    # 36,524 days from 1900 = 92 x 397; 36,525 days from 2000 = 75 x 487.
    first = "IF(year(d) < 2000, DATE'1900-01-01', DATE'2000-01-01')"
    rows, width = "IF(year(d) < 2000, 92, 75)", "IF(year(d) < 2000, 397, 487)"

    def back(x: str, y: str, _: str) -> str:
        return f"date_format(date_add({first}, CAST({x} * {width} + {y} AS INT)), f)"

    permuted = _number_feistel("date", key, [(f"datediff(d, {first}) DIV {width}", rows),
                                             (f"datediff(d, {first}) % {width}", width)], back)
    # Days above 12 of a century, numbered in order: 22,124 = 4 x 5,531 and 22,125 = 125 x 177.
    late_rows, late_width = "IF(year(d) < 2000, 4, 125)", "IF(year(d) < 2000, 5531, 177)"
    month = "((year(d) - year({0})) * 12 + month(d) - 1)".format(first)
    number = f"(datediff(d, {first}) - 12 * ({month} + 1))"
    before = f"(datediff(add_months({first}, n), {first}) - 12 * n)"   # late days before month n

    def late_back(x: str, y: str, _: str) -> str:
        # The month is within one of the mean of 18.4 late days a month.
        guess = "CAST(floor(k / 18.437) AS INT)"
        near = f"filter(sequence(greatest({guess} - 2, 0), least({guess} + 2, 1199)), n -> {before} <= k)"
        day = _let(f"array_max({near})", "n", f"date_add(add_months({first}, n), CAST(12 + k - {before} AS INT))")
        return _let(f"CAST({x} * {late_width} + {y} AS INT)", "k", f"date_format({day}, f)")

    late = _number_feistel("late date", key, [(f"{number} DIV {late_width}", late_rows), (f"{number} % {late_width}", late_width)],
                           late_back)
    body = f"IF(d IS NULL OR year(d) NOT BETWEEN 1900 AND 2099, m, IF(f = 'MM/dd/yyyy', {late}, {permuted}))"
    shape = ("CASE WHEN m LIKE '____-%' THEN 'yyyy-MM-dd' WHEN m LIKE '__.%' THEN 'dd.MM.yyyy' "
             "WHEN try_to_timestamp(m, 'dd/MM/yyyy') IS NULL THEN 'MM/dd/yyyy' ELSE 'dd/MM/yyyy' END")
    return _let(shape, "f", _let("CAST(try_to_timestamp(m, f) AS DATE)", "d", body))


def _card(key: str) -> str:
    body = _string_feistel("card", key, "substr(d, 2, length(d) - 2)")
    permuted = _let(f"concat(substr(d, 1, 1), {body})", "e",
                    _let(f"concat(e, CAST((10 - {_luhn('concat(e, \'0\')')} % 10) % 10 AS STRING))", "g", _fill("m", "g")))
    return _let("regexp_replace(m, '[^0-9]', '')", "d", f"IF({_luhn('d')} % 10 = 0, {permuted}, m)")


_PERMUTE = {"email": _email, "key": _key, "secret": _secret, "phone": _phone, "ip": _ip, "ssn": _ssn, "date": _date,
            "card": _card}


def pseudonym_sql(key: str = DEFAULT_KEY) -> str:
    """SQL for the pseudonym of one candidate ``m``."""
    cases = []
    for kind, pattern in KINDS.items():
        cases.append(f"WHEN m RLIKE {_text(f'^(?:{pattern})$')} THEN {_PERMUTE[kind](key)}")
    return "CASE " + " ".join(cases) + " ELSE m END"


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text",
                 count_col: str | None = None) -> DataFrame:
    """``docs`` with the text's personal data permuted; ``count_col``
    gets the number of values replaced."""
    pattern, text = _text(_pattern()), f"CAST(`{text_col}` AS STRING)"
    names = docs.columns
    found, new = unused(["found", "new"], names)
    # The rest of the texts holds no candidate and skips the long pattern.
    candidates = F.expr(f"CASE WHEN {text} RLIKE {_text(_MAY_HOLD)} THEN regexp_extract_all({text}, {pattern}, 0) END")
    out = docs.select("*", candidates.alias(found))
    out = out.withColumn(new, F.expr(f"transform({found}, m -> {pseudonym_sql(key)})"))
    rebuilt = (f"IF(size({found}) > 0, array_join(zip_with(split({text}, {pattern}, -1), {new}, "
               f"(p, m) -> concat(p, coalesce(m, ''))), ''), {text})")
    count = f"CAST(coalesce(size(filter(zip_with({found}, {new}, (a, b) -> a <> b), x -> x)), 0) AS BIGINT)"
    columns = [F.expr(rebuilt).alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if count_col:
        columns.append(F.expr(f"greatest({count}, 0L)").alias(count_col))
    return out.select(*columns)


def pii_report(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(doc_id, text, n_replaced) of every row."""
    return pseudonymize(docs.select("doc_id", "text"), key, count_col="n_replaced")
