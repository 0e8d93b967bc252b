"""Text parsers as Column expressions.

Each function accepts exactly the text that the corresponding Python parser
accepts (``int``, ``float``, ``datetime.fromisoformat`` (3.11 rules),
``datetime.strptime('%Y-%m-%d')``, ``uuid.UUID``, national id check digit) and
returns the parsed value or NULL.  A shape regex runs before every cast because
Spark's casts are both looser (``5.0`` as a long, ``2023`` as a date, ``1.5d`` as
a double) and stricter (``1_000``) than Python's.  Everything stays JVM-side.

Documented differences: only ASCII digits and whitespace are recognised; ISO
timestamps with a zone (``Z``/``+hh:mm``) are rejected (the original pipeline
crashes on them when it computes the age); the date/time separator must not be
a digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace set (ASCII part).
PY_WHITESPACE = " \t\n\r\x0b\x0c"

# Shapes accepted by Python's parsers.
INT_SHAPE = r"^[+-]?[0-9](_?[0-9])*$"
FLOAT_SHAPE = r"^[+-]?(([0-9](_?[0-9])*)(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
FLOAT_NAN = r"^[+-]?[nN][aA][nN]$"
FLOAT_POS_INF = r"^\+?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
FLOAT_NEG_INF = r"^-[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
ISO_TS_SHAPE = (r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})"
                r"([^0-9]([0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?|[0-9]{4}([0-9]{2}([.,][0-9]+)?)?))?$")
YMD_SHAPE = r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"
UUID_HEX = r"^\+?[0-9a-fA-F](_?[0-9a-fA-F])*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing ASCII whitespace."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def _text(c, stripped: bool) -> Column:
    """The text to parse; one already ``stripped`` is taken as it is."""
    return _col(c) if stripped else py_strip(c)


def parse_int(c, stripped: bool = False) -> Column:
    """``int(text)`` → decimal(38,0), NULL when Python would raise."""
    s = _text(c, stripped)
    return F.when(s.rlike(INT_SHAPE), F.replace(s, F.lit("_"), F.lit("")).try_cast("decimal(38,0)"))


def is_int(c, stripped: bool = False) -> Column:
    return _text(c, stripped).rlike(INT_SHAPE)


def parse_float(c, stripped: bool = False) -> Column:
    """``float(text)`` → double (NaN and ±inf included), NULL when Python raises."""
    s = _text(c, stripped)
    return (F.when(s.rlike(FLOAT_SHAPE), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
            .when(s.rlike(FLOAT_NAN), F.lit(float("nan")))
            .when(s.rlike(FLOAT_POS_INF), F.lit(float("inf")))
            .when(s.rlike(FLOAT_NEG_INF), F.lit(float("-inf"))))


def parse_iso_timestamp(c, stripped: bool = False) -> Column:
    """``datetime.fromisoformat(text)`` for naive values → timestamp_ntz."""
    s = _text(c, stripped)
    d = F.regexp_replace(s, "[^0-9]", "")

    def part(pos: int, n: int, default: str) -> Column:
        p = F.substring(d, pos, n)
        return F.when(p == "", F.lit(default)).otherwise(p)

    canonical = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$")
    frac = F.substring(d, 15, 6)
    norm = F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2), F.lit("-"),
                    F.substring(d, 7, 2), F.lit(" "), part(9, 2, "00"), F.lit(":"),
                    part(11, 2, "00"), F.lit(":"), part(13, 2, "00"),
                    F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    return (F.when(canonical, s.try_cast("timestamp_ntz"))
            .when(s.rlike(ISO_TS_SHAPE), norm.try_cast("timestamp_ntz")))


def parse_ymd_date(c, stripped: bool = False) -> Column:
    """``datetime.strptime(text, '%Y-%m-%d')`` → date."""
    s = _text(c, stripped)
    y = F.regexp_extract(s, YMD_SHAPE, 1)
    m = F.lpad(F.trim(F.regexp_extract(s, YMD_SHAPE, 2)), 2, "0")
    d = F.lpad(F.trim(F.regexp_extract(s, YMD_SHAPE, 3)), 2, "0")
    canonical = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return (F.when(canonical, s.try_cast("date"))
            .when(s.rlike(YMD_SHAPE), F.concat_ws("-", y, m, d).try_cast("date")))


def uuid_ok(c, stripped: bool = False) -> Column:
    """``uuid.UUID(text)`` succeeds: strip ``urn:``/``uuid:``, braces, hyphens; 32 hex digits."""
    s = _text(c, stripped)
    s = F.replace(F.replace(s, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    s = F.replace(F.trim(s, F.lit("{}")), F.lit("-"), F.lit(""))
    return (F.length(s) == 32) & s.rlike(UUID_HEX)


def _weighted_by_lambda(body: Column) -> Column:
    """Σ digit·weight for any length (array functions; used only beyond the arithmetic range)."""
    digits = F.reverse(F.split(body, ""))
    weighted = F.transform(digits, lambda x, i: x.try_cast("int") * (F.lit(2) + i % 6))
    return F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)


def _weighted_by_arithmetic(body: Column, width: int = 12) -> Column:
    """The same sum for bodies of at most ``width`` digits: the character codes from the right.

    A digit costs one character of the body; places before its start count as 0.
    """
    total = F.lit(0)
    for i in range(width):
        digit = F.ascii(F.substring(body, -1 - i, 1)) - F.lit(48)
        total = total + F.when(F.length(body) > i, digit).otherwise(F.lit(0)) * F.lit(2 + i % 6)
    return total


def _check_digit_of_digits(body: Column) -> Column:
    """``check_digit`` of a text known to be digits."""
    total = F.when(F.length(body) <= 12, _weighted_by_arithmetic(body)).otherwise(_weighted_by_lambda(body))
    # 11 - total mod 11, as one character of a text: 11 is '0', 10 is 'K'.
    return F.substring(F.lit("0K987654321"), total % 11 + F.lit(1), F.lit(1))


def check_digit(body) -> Column:
    """Mod-11 check digit of a digit string: weights 2..7 from the right, cycling; 11→'0', 10→'K'.

    Exact for any length, NULL for other text.  Bodies of up to 12 digits (every
    real id) use plain integer arithmetic, which compiles into the generated code;
    longer ones fall back to array functions, evaluated only on that branch.
    """
    b = _col(body)
    return F.when(b.rlike(r"^[0-9]*\z"), _check_digit_of_digits(b))


def check_digit_of_int(n: Column) -> Column:
    """``check_digit`` of the decimal text of an integer: no text is cut where it has at most 12 digits."""
    total = F.lit(0).cast("long")
    for i in range(12):
        total = total + F.call_function("div", n, F.lit(10 ** i)) % 10 * (2 + i % 6)
    digit = F.substring(F.lit("0K987654321"), (total % 11 + 1).cast("int"), F.lit(1))
    return F.when((n >= 0) & (n < 10 ** 12), digit).otherwise(check_digit(n.cast("string")))


def national_id_ok(c, stripped: bool = False) -> Column:
    """Check-digit rule on text like ``12.345.678-5`` or ``123456785``."""
    t = F.replace(F.replace(F.upper(_text(c, stripped)), F.lit("."), F.lit("")), F.lit("-"), F.lit(""))
    n = F.length(t)
    body = t.substr(F.lit(1), n - 1)
    dv = t.substr(n, F.lit(1))
    return F.coalesce((n >= 2) & body.rlike(r"^[0-9]+\z") & (dv == _check_digit_of_digits(body)), F.lit(False))
