"""Scalar expressions on rows and pixels; everything here stays inside whole-stage code generation."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), "(?<=.)\\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Last suffix without the dot, case kept; empty without one."""
    return F.regexp_extract(file_name(path), "^.+\\.([^.]*)$", 1)


def moved_to(path: Column, directory: str) -> Column:
    """The same file name in another directory."""
    return F.concat_ws("/", F.lit(directory), file_name(path))


def normalize_mask(v: Column) -> Column:
    """Byte to 0/1, half to even as in numeric rounding: 128 and more is 1."""
    return F.bround(v / F.lit(255.0)).cast("int")


def unit_scale(v: Column) -> Column:
    return v / F.lit(255.0)


def unit_scale_rounded(v: Column, digits: int = 6) -> Column:
    """``unit_scale`` rounded half up. Bytes look theirs up, since rounding a double goes through a decimal for each pixel."""
    step = Decimal(1).scaleb(-digits)
    table = F.array(*[F.lit(float(Decimal(repr(b / 255.0)).quantize(step, ROUND_HALF_UP))) for b in range(256)])
    return F.coalesce(F.get(table, v), F.round(unit_scale(v), digits))


def threshold_logit(logit: Column) -> Column:
    return (logit > 0).cast("int")


def threshold_sigmoid(logit: Column, at: float = 0.5) -> Column:
    return (1 / (1 + F.exp(-logit)) > at).cast("int")


def scale_mask(pred: Column) -> Column:
    return pred * 255


def relu(v: Column) -> Column:
    return F.greatest(v, F.lit(0).cast("double"))


def luma(r: Column, g: Column, b: Column) -> Column:
    """8-bit luma with 16-bit fixed-point weights."""
    return F.shiftright(r * 19595 + g * 38470 + b * 7471 + 32768, 16)


def round_byte(x: Column) -> Column:
    """Real value to a byte: rounded at 6 decimals first, so that sums taken in another order agree, then half up."""
    return F.least(F.greatest(F.floor(F.round(x, 6) + 0.5), F.lit(0)), F.lit(255)).cast("int")


def bce(logit: Column, target: Column) -> Column:
    """Binary cross-entropy of a logit, without overflow for large ones."""
    return F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))
