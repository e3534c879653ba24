"""Deterministic uniform draws and the search objective, as column expressions.

A draw is a hash of its coordinates (seed, run, generation, slot, tag), so it
does not depend on partitioning or on execution order, a lost task recomputes
the same values, and the same number can be produced in SQL. One md5 gives
four 32-bit draws (``chunk`` 0..3):
``conv(substr(md5('seed|run|generation|slot|tag'), 1 + 8·chunk, 8), 16, 10) / 2^32``.
Draws that share a key share one md5 evaluation (Catalyst eliminates the
common subexpression).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _text(c: Column | str | int) -> Column:
    if isinstance(c, Column):
        return c.cast("string")
    if isinstance(c, str):
        return F.col(c).cast("string")
    return F.lit(str(c))


def uniform(seed, run, generation, slot, tag: str | Column, chunk: int = 0) -> Column:
    """U[0, 1) from 32 bits (``chunk`` 0..3) of an md5 over the coordinates."""
    return uniform_from_hash(draw_hash(seed, run, generation, slot, tag), chunk)


def draw_hash(seed, run, generation, slot, tag: str | Column) -> Column:
    """The md5 hex string behind up to four draws of one key."""
    tag_col = tag if isinstance(tag, Column) else F.lit(tag)
    return F.md5(F.concat_ws("|", _text(seed), _text(run), _text(generation), _text(slot), tag_col))


def uniform_from_hash(hex_md5: Column, chunk: int) -> Column:
    """Draw ``chunk`` (0..3) of an md5 hex string, as ``uniform`` computes it."""
    if not 0 <= chunk <= 3:
        raise ValueError("an md5 holds four 32-bit draws")
    return F.conv(F.substring(hex_md5, 1 + 8 * chunk, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def uniform_between(low: Column | float, high: Column | float, u: Column) -> Column:
    lo = low if isinstance(low, Column) else F.lit(float(low))
    hi = high if isinstance(high, Column) else F.lit(float(high))
    return lo + (hi - lo) * u


def standard_normal(u1: Column, u2: Column) -> Column:
    """Box–Muller: sqrt(-2 ln(1 - u1)) · cos(2π u2); ``1 - u1`` is never 0."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def objective(x: Column | str, y: Column | str) -> Column:
    """20 − (x² + y²) + 10·(cos 2πx + cos 2πy); maximum 40 at (0, 0)."""
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    two_pi = F.lit(2.0 * math.pi)
    return F.lit(20.0) - (xc * xc + yc * yc) + F.lit(10.0) * (F.cos(two_pi * xc) + F.cos(two_pi * yc))
