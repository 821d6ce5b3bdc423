"""Hierarchical hexagonal cell ids as 64-bit integers: bit arithmetic in native expressions.

Layout: mode in bits 59-62, resolution in 52-55, base cell in 45-51, then fifteen digits of
three bits from the coarsest down; unused digits are 7. A parent is therefore an ``and`` and two
``or``s, which stay inside whole-stage code generation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom.functions import grid

RESOLUTION_MASK = 15 << 52


def resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def parent(cell: Column, res: int) -> Column:
    """The cell of resolution ``res`` above (or equal to) ``cell``; null stays null."""
    if not 0 <= res <= 15:
        raise ValueError("resolution is 0 to 15")
    low = (1 << (3 * (15 - res))) - 1
    return cell.bitwiseAND(F.lit(~RESOLUTION_MASK)).bitwiseOR(F.lit((res << 52) | low))


def parent_at(cell: Column, res: Column) -> Column:
    """The cell above ``cell`` whose resolution is in a column."""
    low = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(15) - res) * 3) - 1
    return cell.bitwiseAND(F.lit(~RESOLUTION_MASK)).bitwiseOR(F.call_function("shiftleft", res.cast("long"), F.lit(52))).bitwiseOR(low)


def to_string(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def from_string(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def synthetic(x: Column, res: int = 10) -> Column:
    """A well-formed cell for a whole number, for tables without coordinates; the finest digit varies fastest."""
    cell = F.lit((1 << 59) + (res << 52) + (1 << (3 * (15 - res))) - 1) + (F.lit(15) + x % 8) * F.lit(1 << 45)
    for i in range(1, res + 1):
        cell = cell + (F.floor(x / F.lit(8 * 7 ** (res - i))) % 7) * F.lit(1 << (3 * (15 - i)))
    return cell.cast("long")


def latlng_to_cell(lat: Column, lng: Column, res: int) -> Column:
    """Cell of a point in degrees, latitude first; null and non-finite coordinates give null. Arrow batches."""
    if not 0 <= res <= 15:
        raise ValueError("resolution is 0 to 15")
    grid.layout()  # worked out here, and sent along

    @F.arrow_udf("long")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        cells = grid.encode(*(np.asarray(x.fill_null(np.nan).to_numpy(zero_copy_only=False), float) for x in (a, b)), res)
        return pa.array(cells, mask=cells == 0)

    return run(lat.cast("double"), lng.cast("double"))


def cell_to_latlng(cell: Column) -> Column:
    """struct<lat, lng> of a cell's centre, in degrees; null fields for null and for what is no cell. Arrow batches."""
    grid.layout()

    @F.arrow_udf("lat double, lng double")
    def run(cells: pa.Array) -> pa.Array:
        lat, lng = grid.decode(np.asarray(cells.fill_null(0).to_numpy(zero_copy_only=False), np.int64))
        none = np.isnan(lat)
        return pa.StructArray.from_arrays([pa.array(lat, mask=none), pa.array(lng, mask=none)], ["lat", "lng"])

    return run(cell)
