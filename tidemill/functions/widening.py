"""Safe widenings: which column types hold every value of another one unchanged."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

MAX_PRECISION = 38
# Whole numbers, narrowest first, with the most decimal digits that they have.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
# Whole numbers that each floating type holds exactly.
EXACT_IN = {FloatType(): (ByteType(), ShortType()), DoubleType(): (ByteType(), ShortType(), IntegerType())}


def as_decimal(kind: DataType) -> DecimalType | None:
    """The narrowest decimal for a whole number or decimal, None for all others."""
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(DIGITS[kind], 0) if kind in DIGITS else None


def widens(have: DataType, want: DataType) -> bool:
    """Whether a cast from ``have`` to ``want`` keeps every value.

    Whole numbers go to longer ones, to decimals with enough digits before the point and to floating
    numbers that hold them exactly; decimals to those with no fewer digits on either side; float to
    double; a date to midnight of a timestamp, in the session's time zone where it has one. Nothing
    goes to or from text, and nested types only fit themselves.
    """
    if have == want:
        return True
    if have in DIGITS and want in DIGITS:
        return DIGITS[have] < DIGITS[want]
    exact = as_decimal(have)
    if exact is not None and isinstance(want, DecimalType):
        whole = exact.precision - exact.scale
        return want.scale >= exact.scale and want.precision - want.scale >= whole
    if want in EXACT_IN:
        return have in EXACT_IN[want] or (have, want) == (FloatType(), DoubleType())
    return have == DateType() and want in (TimestampType(), TimestampNTZType())


def common_type(left: DataType, right: DataType) -> DataType | None:
    """The narrowest type that both widen to, None if there is none."""
    options = [left, right]
    a, b = as_decimal(left), as_decimal(right)
    if a is not None and b is not None:
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= MAX_PRECISION:
            options.append(DecimalType(precision, scale))
    options.append(DoubleType())
    return next((t for t in options if widens(left, t) and widens(right, t)), None)
