"""Column helpers. All of them stay inside generated JVM code and ignore the session time zone."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed labels of the payment codes.
PAYMENT_TYPES = {
    0: "Flex fare",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT = "Other"
CARD = 1

# Fixed service zones that are airports.
AIRPORT_SERVICE_ZONES = ("Airports", "EWR")

# The largest DECIMAL(10,2).
MAX_MONEY = 99_999_999.99
MAX_PLAUSIBLE_MPH = 100
MIN_SPEED_MINUTES = 1


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """DOUBLE division that is NULL where the denominator is zero or NULL."""
    below = denominator.cast("double")
    return numerator.cast("double") / F.nullif(below, F.lit(0.0))


def cents(amount: Column) -> Column:
    """Whole cents of a DOUBLE amount, halves away from zero.

    Works on the binary value times 100, so 1.005 is 100 cents. Going through the printed
    decimal, as a plain cast does, would give 101. For finite amounts.
    """
    return F.round(amount * F.lit(100.0)).cast("bigint")


def money(amount: Column) -> Column:
    """DECIMAL(10,2) of a DOUBLE amount that it can hold, built from whole cents without parsing text."""
    return (cents(amount) * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def rounds_below_zero(amount: Column) -> Column:
    """Whether ``money(amount) < 0``, told from the DOUBLE alone."""
    return amount * F.lit(100.0) <= F.lit(-0.5)


def rounds_above(amount: Column, high: float) -> Column:
    """Whether ``money(amount) > high``, told from the DOUBLE alone. NaN is above every bound."""
    return amount * F.lit(100.0) >= F.lit(float(high) * 100 + 0.5)


def number_text(value: Column) -> Column:
    """Text of a DOUBLE in shortest form, without an exponent from 1e-4 up to 1e16.

    Spark's own cast switches to an exponent below 1e-3 and from 1e7 on. Beyond the range its text, as
    unique as any other, stays.
    """
    text = value.cast("string")
    plain = F.regexp_replace(text.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")) & (F.abs(value) < F.lit(1e16)), plain).otherwise(text)


def trip_key() -> Column:
    """md5 over the eight identifying raw columns; NULL parts are skipped."""
    return F.md5(
        F.concat_ws(
            "|",
            F.col("VendorID").cast("string"),
            F.col("tpep_pickup_datetime").cast("string"),
            F.col("tpep_dropoff_datetime").cast("string"),
            F.col("PULocationID").cast("string"),
            F.col("DOLocationID").cast("string"),
            number_text(F.col("trip_distance")),
            number_text(F.col("fare_amount")),
            number_text(F.col("total_amount")),
        )
    )


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``: 0.9 s to 1.1 s counts as one."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 86400 + (_second_of_day(end) - _second_of_day(start))


def duration_minutes(start: Column, end: Column) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(60.0)


def avg_speed_mph(miles: Column, minutes: Column) -> Column:
    """Miles per hour, NULL for trips under a minute, without distance or faster than 100 mph."""
    speed = safe_divide(miles, minutes / F.lit(60.0))
    plausible = (minutes >= MIN_SPEED_MINUTES) & (miles > 0) & (speed <= MAX_PLAUSIBLE_MPH)
    return F.when(plausible, speed)


def tip_pct(payment_type: Column, tip: Column, fare: Column) -> Column:
    """Tip in percent of the fare for card trips with a fare, else NULL."""
    # A DECIMAL(10,2) tip times 100 is a whole number, which rint restores exactly.
    tip_cents = F.rint(tip.cast("double") * F.lit(100.0))
    return F.when((payment_type == CARD) & (fare > 0), safe_divide(tip_cents, fare))


def payment_type_name(code: Column) -> Column:
    label = F.lit(OTHER_PAYMENT)
    for value, name in reversed(PAYMENT_TYPES.items()):
        label = F.when(code == value, F.lit(name)).otherwise(label)
    return label


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(ts) + 1).cast("int")


def is_weekend(ts: Column) -> Column:
    return iso_weekday(ts).isin(6, 7)


def month_of(ts: Column) -> Column:
    """First day of the timestamp's month, as a DATE."""
    return F.trunc(F.to_date(ts), "month")
