"""Repeatable stand-ins for random draws, computed from row keys.

``rand`` depends on how rows are spread over partitions and changes on a
retried task; these depend on the key alone. The digits of an MD5 digest serve as
the hash: every engine has it, it names its input once (an expression that repeats
its input grows with every step), and a salt before the key gives a draw of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2147483648
DIGITS = 8


def key_hash(*columns: str, salt: int = 0) -> Column:
    """Integer hash in [0, 2^31) of one or several integer key columns; NULL if one of them is."""
    keys = [F.col(c).cast("bigint").cast("string") for c in columns]
    text = F.concat(F.lit(str(salt)), *[part for key in keys for part in (F.lit(":"), key)])
    digits = F.substring(F.md5(text.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").bitwiseAND(F.lit(MODULUS - 1))


def key_uniform(*columns: str, salt: int = 0) -> Column:
    """A double in [0, 1). The divisor is a double: a decimal one loses digits."""
    return key_hash(*columns, salt=salt).cast("double") / F.lit(float(MODULUS))


def uniform_int(low: int, high: int, *columns: str, salt: int = 0) -> Column:
    """An integer from ``low`` to ``high``, both included."""
    return F.lit(low) + bucket_index(key_uniform(*columns, salt=salt), high - low + 1)


def uniform_float(low: float, high: float, *columns: str, salt: int = 0) -> Column:
    return F.lit(float(low)) + key_uniform(*columns, salt=salt) * F.lit(float(high - low))


def bucket_index(fraction: Column, buckets: int, power: float = 1.0) -> Column:
    """Bucket 0 .. n-1 of a fraction; a power above 1 favours the first buckets."""
    shaped = fraction if power == 1.0 else F.pow(fraction, F.lit(power))
    return F.least(F.floor(shaped * buckets).cast("bigint"), F.lit(buckets - 1).cast("bigint"))


def weighted_pick(values: list[str], fraction: Column, power: float = 1.0) -> Column:
    """One of ``values``; a value that is listed twice is twice as likely."""
    index = bucket_index(fraction, len(values), power).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def share_pick(shares: list[tuple[float, str]], otherwise: str, fraction: Column) -> Column:
    """Category by cumulative share: the first bound above the fraction."""
    from cohortry.functions.ladders import ladder

    return ladder([(fraction < bound, label) for bound, label in shares], otherwise)
