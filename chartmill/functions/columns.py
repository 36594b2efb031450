"""Column expressions: guarded casts, text clean-up, unit and code rules.  All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, TimestampNTZType

# Patterns for text that counts as a number or a whole number.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"

# Feet-and-inches text, scientific notation, LOINC shape, 16-digit hex id.
FEET_INCHES = r"^(\d+)'\s(\d+(?:\.\d+)?)$"
SCIENTIFIC = r"[Ee][+-]"
LOINC = r"^\d+-\d$"
HEX_ID = r"^[0-9a-f]{16}$"

# Spelling variants of units and their canonical form.
UNIT_SPELLINGS = {"cmH20": "cmH2O", "l/min": "L/min", "ml": "mL"}

# One disposition wording that changed during the collection period.
DISPOSITION_WORDING = {
    "Designated Disaster Alternative Care Site": "Designated Disaster Alternate Care Site",
}

# Conversion factor and age cap.
KG_PER_OUNCE = 0.0283495
AGE_CAP = 90

# Billing code systems recognised by the shape of the code, first match wins.
CODE_SHAPES = {
    "CPT": r"^[0-9]{5}$",
    "CPT III": r"^[0-9]{4}T$",
    "HCPCS II": r"^[A-V][0-9]{4}$",
    "ICD-10-PCS": r"^[0-9A-HJ-NP-Z]{7}$",
    "ICD-10-CM": r"^[A-Z][0-9][0-9AB](\.[0-9A-Z]{1,4})?$",
}

# Fixed value: the "no map" diagnosis code of the source vocabulary.
PLACEHOLDER_CODE = "IMO0001"

# Fixed value: laboratory value that stands for "not a number".
LAB_SENTINEL = 9999999.0


def first_match(cases: Iterable[tuple[Column, Column | str | None]], default: Column | str | None = None) -> Column:
    """CASE with the given (condition, value) pairs in order."""
    pairs = [(cond, value if isinstance(value, Column) else F.lit(value)) for cond, value in cases]
    head, *tail = pairs
    chain = reduce(lambda acc, pair: acc.when(*pair), tail, F.when(*head))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def null_tokens(text: Column, tokens: Iterable[str]) -> Column:
    """Texts that mean "no value" become null."""
    return F.when(~text.isin(list(tokens)), text)


def to_double(text: Column) -> Column:
    """Numeric text to double; anything else, and NaN, becomes null.

    The pattern guard is needed because a bare cast accepts type suffixes such as ``5d``.
    """
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole numbers, also when written ``12.0``; a fractional or out-of-range value becomes null."""
    value = to_double(text)
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(float(2**63)))
    return F.when(text.rlike(WHOLE_NUMBER), F.trim(text).try_cast("bigint")).otherwise(
        F.when(whole, value.try_cast("bigint"))
    )


def to_timestamp(text: Column, formats: Iterable[str] = ()) -> Column:
    """ISO text first, then each pattern; no zone.  Needs the session zone to be UTC."""
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(*tries)


def coerce(text: Column, kind: DataType, formats: Iterable[str] = ()) -> Column:
    """Text to the declared type; what does not parse becomes null."""
    if isinstance(kind, LongType):
        return to_long(text)
    if isinstance(kind, DoubleType):
        return to_double(text)
    if isinstance(kind, TimestampNTZType):
        return to_timestamp(text, formats)
    return text


def split_mixed(text: Column) -> tuple[Column, Column]:
    """A measure that is sometimes a number and sometimes words: (number, words)."""
    number = to_double(text)
    return number, F.when(number.isNull(), text)


def parse_feet_inches(text: Column) -> Column:
    """``5' 10.5`` to 70.5 inches; any other form to null."""
    cleaned = F.trim(text)
    feet = F.regexp_extract(cleaned, FEET_INCHES, 1).try_cast("double")
    inches = F.regexp_extract(cleaned, FEET_INCHES, 2).try_cast("double")
    return feet * 12 + inches


def map_values(text: Column, mapping: Mapping[str, str]) -> Column:
    """Trim, then replace the listed values."""
    cleaned = F.trim(text)
    return first_match([(cleaned == old, new) for old, new in mapping.items()], cleaned)


def normalize_units(text: Column) -> Column:
    """Canonical unit spelling; text with a comma or a double quote is debris of a broken record."""
    debris = text.contains(",") | text.contains('"')
    return F.when(~debris, map_values(text, UNIT_SPELLINGS))


def ounces_to_kg(ounces: Column, factor: float = KG_PER_OUNCE) -> Column:
    return ounces * F.lit(factor)


def null_out(value: Column, key: Column, ids: Iterable[str]) -> Column:
    """Null the value of the rows named by id."""
    listed = list(ids)
    return F.when(~key.isin(listed), value) if listed else value


def flag_pattern(text: Column, pattern: str = SCIENTIFIC) -> Column:
    return text.rlike(pattern)


def flag_capped(value: Column, cap: int = AGE_CAP) -> Column:
    """True at the cap, false below, null when unknown."""
    return value == F.lit(cap)


def flag_sentinel(value: Column, sentinel: float = LAB_SENTINEL) -> Column:
    return F.coalesce(value == F.lit(sentinel), F.lit(False))


def null_sentinel(value: Column, sentinel: float = LAB_SENTINEL) -> Column:
    return F.when(value != F.lit(sentinel), value)


def null_placeholder_code(code: Column, placeholder: str = PLACEHOLDER_CODE) -> Column:
    return F.nullif(code, F.lit(placeholder))


def strip_prefix(text: Column, prefix: str = "0 ") -> Column:
    """Remove a stray leading text; everything else is unchanged."""
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def classify_code(code: Column) -> Column:
    """The code system a billing code belongs to, judged by its shape and not by its label."""
    upper = F.upper(F.trim(code))
    cases = [(upper.rlike(shape), system) for system, shape in CODE_SHAPES.items()]
    return F.when(code.isNotNull(), first_match(cases, "other"))


def id_format(text: Column) -> Column:
    """How an id is written: 16 hex digits, scientific notation, or something else."""
    return first_match([(text.rlike(HEX_ID), "hex16"), (text.rlike(SCIENTIFIC), "scientific")], "other")


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(60_000_000.0)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


# The layout of a double, and the step between times packed above 64-bit values.
_FRACTION, _LEAST_EXPONENT, _INFINITE = 2**52, -1022, 2047 * 2**52
_STEP = Decimal(2**64)
_UNKNOWN_TIME = -5 * 10**18


def order_code(value: Column) -> Column:
    """A double as a 64-bit whole number in the same order, -0.0 being 0.0 and NaN the largest.

    It is the number's own bit pattern, found by arithmetic that rounds nothing: the exponent is guessed
    from the logarithm and put right by comparison, and division by a power of two is exact.
    """
    size = F.abs(value)
    guess = F.coalesce(F.floor(F.log2(size)).cast("int"), F.lit(_LEAST_EXPONENT))
    near = F.greatest(F.least(guess, F.lit(1023)), F.lit(_LEAST_EXPONENT))
    down = (size < F.pow(F.lit(2.0), near)).cast("int")
    up = ((near < 1023) & (size / F.pow(F.lit(2.0), near) >= 2.0)).cast("int")
    exponent = F.greatest(near - down + up, F.lit(_LEAST_EXPONENT))
    finite = (exponent - _LEAST_EXPONENT).cast("long") * _FRACTION + (size / F.pow(F.lit(2.0), exponent) * float(_FRACTION)).cast("long")
    code = F.when(size == F.lit(float("inf")), F.lit(_INFINITE)).otherwise(finite)
    return F.when(F.isnan(value), F.lit(_INFINITE + 1)).when(value < 0, -code).otherwise(code)


def from_order_code(code: Column) -> Column:
    """The double behind an :func:`order_code`."""
    size = F.abs(code)
    exponent = F.floor(size / F.lit(_FRACTION)).cast("int")
    exponent = F.when(exponent.cast("long") * _FRACTION > size, exponent - 1).otherwise(exponent)
    rest = (size - exponent.cast("long") * _FRACTION).cast("double") / float(_FRACTION)
    finite = F.when(exponent == 0, rest * F.pow(F.lit(2.0), F.lit(_LEAST_EXPONENT))).otherwise(
        (1.0 + rest) * F.pow(F.lit(2.0), exponent - 1 - F.lit(-_LEAST_EXPONENT))
    )
    whole = F.when(size == _INFINITE, F.lit(float("inf"))).otherwise(F.when(size < _INFINITE, finite))
    return F.when(size > _INFINITE, F.lit(float("nan"))).when(code < 0, -whole).otherwise(whole)


def packed(ts: Column, code: Column) -> Column:
    """A time and a 64-bit value as one decimal in the order of (time, value), no time being the earliest.

    A decimal is of fixed width, so groups keep their largest one in a hash aggregate; a struct would sort.
    """
    micros = F.coalesce(epoch_micros(ts), F.lit(_UNKNOWN_TIME)).cast("decimal(19,0)")
    return (micros * F.lit(_STEP) + code.cast("decimal(20,0)")).cast("decimal(38,0)")


def unpacked(pair: Column) -> Column:
    """The value of a :func:`packed` pair."""
    half = F.lit(_STEP / 2)
    return (F.pmod(pair + half, F.lit(_STEP)) - half).cast("long")


def extremes(columns: Iterable[str], when: Column | None = None) -> list[Column]:
    """Aggregates: smallest and largest of two 64-bit hashes of a tuple, over rows where a condition holds.

    Whether fields are null is hashed too, because a hash passes over nulls: a null field is a value.
    """
    values = [F.col(name) for name in columns]
    hashes = [F.xxhash64(*seed, *values, *[v.isNull() for v in values]) for seed in ((), (F.lit(1),))]
    return [edge(h if when is None else F.when(when, h)) for h in hashes for edge in (F.min, F.max)]


def apart(prefix: str, n: int) -> Column:
    """Do the extremes, in columns named by a prefix and a number, tell of more than one value?"""
    pairs = [F.coalesce(F.col(f"{prefix}{i}") != F.col(f"{prefix}{i + 1}"), F.lit(False)) for i in range(0, n, 2)]
    return reduce(lambda a, b: a | b, pairs)


# Types of fixed width and total order: the extremes of their values are as short as those of a hash, and pack better.
FIXED_WIDTH = frozenset(("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"))


def differs(column: str, kind: str = "") -> Column:
    """Aggregate: does the group hold more than one value, null counting as a value?

    Compares the smallest and the largest of two 64-bit hashes instead of counting distinct values: the
    state is constant and of fixed width, so groups are aggregated by hash, whatever the type.  Values of
    a ``kind`` that is itself of fixed width are compared as they are.
    """
    value = F.col(column)
    mixed_nulls = (F.count(value) > 0) & (F.count(value) < F.count(F.lit(1)))
    if kind in FIXED_WIDTH:
        return mixed_nulls | F.coalesce(F.min(value) != F.max(value), F.lit(False))
    hashes = [F.when(value.isNotNull(), F.xxhash64(*seed, value)) for seed in ((), (F.lit(1),))]
    unlike = [F.coalesce(F.min(h) != F.max(h), F.lit(False)) for h in hashes]
    return mixed_nulls | unlike[0] | unlike[1]
