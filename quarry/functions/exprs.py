"""Column functions: normalising, rendering, classifying and hashing values, all JVM-side.

Only the keyed digest runs in Python (a pandas UDF), because a key in a Catalyst literal
would show in plans and event logs.
"""

from __future__ import annotations

import hashlib
import hmac
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The formats in which text is read as a time, tried in order.
INSTANTS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd",
    "MMM d yyyy hh:mma", "MMM d yyyy hh:mm:ssa", "yyyy/M/d H:mm:ss", "yyyy/M/d",
)


def as_text(c: Column, kind: T.DataType) -> Column:
    """Text to show and sample, the same on every engine: times rendered, binary floats as decimals where six places hold them exactly."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return render_time(c)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        plain = c.try_cast("decimal(38,6)")
        return F.when(plain.cast(kind) == c, plain.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def identity(c: Column, kind: T.DataType) -> tuple[Column, Column, Column]:
    """(long, double, text), of which one is set: what tells values of a column apart, without rendering.

    Grouping takes all NaN for one value, and both zeros.
    """
    none = F.lit(None)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("long"), none.cast("double"), none.cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long"), none.cast("double"), none.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return none.cast("long"), c.cast("double"), none.cast("string")
    if isinstance(kind, T.BinaryType):
        return none.cast("long"), none.cast("double"), F.hex(c)
    return none.cast("long"), none.cast("double"), c.cast("string")  # times with their microseconds, decimals with their scale


def normalize(c: Column) -> Column:
    return F.upper(F.trim(c))


def strip_zeros(c: Column) -> Column:
    """Drop leading zeros of all-digit text, keeping one digit."""
    return F.when(c.rlike(r"^\p{Nd}+$"), F.regexp_replace(c, r"^0+(?=.)", "")).otherwise(c)


def render_time(c: Column) -> Column:
    """Y/M/D without padding, and H:MM:SS behind it unless it is midnight."""
    day = F.concat_ws("/", F.year(c).cast("string"), F.month(c).cast("string"), F.day(c).cast("string"))
    stamp = c.cast("timestamp_ntz")
    clock = F.concat(
        F.lit(" "), F.hour(stamp).cast("string"), F.lit(":"), F.lpad(F.minute(stamp).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.second(stamp).cast("string"), 2, "0")
    )
    return F.when(c.isNotNull(), F.when(stamp == F.date_trunc("day", stamp).cast("timestamp_ntz"), day).otherwise(F.concat(day, clock)))


def parse_time(c: Column) -> Column:
    """The instant in text after white space is collapsed; null if no format fits."""
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    tries = [F.try_to_timestamp(F.regexp_replace(text, r"(\.\d{1,6})$", "$1") if "S" in f else text, F.lit(f.replace("SSSSSS", "[SSSSSS][SSSSS][SSSS][SSS][SS][S]"))) for f in INSTANTS]
    return F.coalesce(*tries)


def format_class(c: Column) -> Column:
    """email, all-digits, phone-like, alpha or mixed."""
    text = F.trim(c)
    digits = F.length(F.regexp_replace(text, r"[^\p{Nd}]", ""))
    return (
        F.when(text == "", "mixed")
        .when(text.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "email")
        .when(text.rlike(r"^\p{Nd}+$"), "all-digits")
        .when(~text.rlike(r"\p{L}") & (digits >= 7) & text.rlike(r"^[\p{Nd}+\-() ]+$"), "phone-like")
        .when(text.rlike(r"\p{L}") & text.rlike(r"^[\p{L} .\-'’]+$"), "alpha")
        .otherwise("mixed")
    )


def digest(c: Column) -> Column:
    """First 16 hexadecimal digits of the sha256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def keyed_digest(key_variable: str):
    """A function like digest() with HMAC under the key in that environment variable."""
    key = os.environ.get(key_variable, "").encode()
    if not key:
        raise ValueError(f"{key_variable} holds no key")

    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else hmac.new(key, v.encode(), hashlib.sha256).hexdigest()[:16])

    return run


def rank_hash(c: Column) -> Column:
    """What samples are ordered by, the same for every source."""
    return F.md5(c)


def percent(part: Column, whole: Column) -> Column:
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0)).otherwise(F.bround(100 * part / whole)).cast("int")
