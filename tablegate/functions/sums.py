"""Sums that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.columns import col

#: A double is cut into limbs of so many bits, from below ``2 ** HIGHEST`` down to ``2 ** LOWEST``.
BITS, HIGHEST, LOWEST = 24, 72, -72


def steady_sum(df: DataFrame, name: str, where: Column | None = None) -> Column:
    """The sum of a numeric column as a double, 0 without values; the same bits however the rows are dealt.

    Whole numbers and decimals add up exactly. A double is written as whole multiples of 2**48, 2**24, 1, ... 2**-72,
    each of 24 bits. Their sums are exact in longs for 2**39 rows, so no order matters; what a double has below 2**-72
    is left out, which only those below 2**-20 have. A column with a value of 2**72 or more, or one that is not finite,
    is added up as it is.
    """
    value = col(name)
    value = value if where is None else F.when(where, value)
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(F.sum(value), F.lit(0)).cast("double")
    value = value.cast("double")
    fits = F.abs(value) < float(2**HIGHEST)
    inside, limbs = F.when(fits, value), []
    for power in range(HIGHEST - BITS, LOWEST - 1, -BITS):
        # Remainders of powers of two are exact, and so is the difference of two.
        limb = (inside % F.lit(2.0 ** (power + BITS)) - inside % F.lit(2.0**power)) / F.lit(2.0**power)
        limbs.append((2.0**power, F.coalesce(F.sum(limb.cast("bigint")), F.lit(0))))
    # The highest limbs come first: what they make is exact but for the last bits, whatever the order of the rows.
    total = F.lit(0.0)
    for unit, limb in limbs:
        total = total + limb.cast("double") * unit
    odd = F.count_if(~fits)
    return F.when(odd > 0, F.sum(value)).otherwise(total)
