"""Numbers from text, and reproducible fractions from keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: Column, kind: str = "double") -> Column:
    """Number of a text, null where it is none (a plain cast would fail the job)."""
    return column.try_cast(kind)


def key_fraction(seed: int | str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on seed and key only.

    Unlike ``rand(seed)`` it does not change with the layout of the data or when a lost
    task is run again, and other SQL engines give the same value.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    digits = F.substring(F.md5(text), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**32))
