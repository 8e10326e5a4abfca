"""Pixel functions: normalised difference, clip, colour index. Holes are NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_difference(nir: Column, red: Column, clip: bool = True) -> Column:
    """(nir - red) / (nir + red) as float; NULL where the sum is 0 or the result is not a number; clipped to
    -1..1. Infinite quotients are clipped, so they stay valid."""
    a, b = nir.cast("float"), red.cast("float")
    total = a + b
    ratio = F.when(total != 0, ((a - b) / total).cast("float"))
    ratio = F.when(~F.isnan(ratio), ratio)
    # greatest() and least() skip NULLs, so the clip stands inside the test for holes.
    return F.when(ratio.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)).cast("float")) if clip else ratio


def block_difference(nir: Column, red: Column) -> Column:
    """The same over two arrays of values."""
    return F.zip_with(nir, red, lambda n, r: normalized_difference(n, r))


def color_index(value: Column, colors: int = 256) -> Column:
    """Place in a colour map over -1..1; NULL stays uncoloured."""
    return F.when(value.isNotNull(), F.least(F.lit(colors - 1), F.floor((value + 1) / 2 * colors)).cast("int"))


def centre_window(width: Column, height: Column, fraction: Column) -> Column:
    """(col_off, row_off, width, height): a centred part of the frame, 2 * fraction of each side by half-even
    rounding, at least one pixel; the whole frame for fractions outside (0, 0.5]."""
    part = lambda n: F.greatest(F.lit(1), F.least(F.rint(n * (2 * fraction)).cast("int"), n))
    inside = (fraction > 0) & (fraction <= 0.5)
    w, h = (F.when(inside, part(n)).otherwise(n) for n in (width, height))
    off = lambda n, m: F.greatest(F.lit(0), F.floor((n - m) / 2).cast("int"))
    return F.struct(off(width, w).alias("col_off"), off(height, h).alias("row_off"), w.alias("width"), h.alias("height"))
