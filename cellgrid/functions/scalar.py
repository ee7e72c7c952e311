"""Column expressions shared by the operators. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the instrument: pixels and micrometres of a tile's side, and the step of a z slice.
PIXELS, TILE, Z_STEP = 2048, 220.0, 6.333333
#: A cell id is this many times its tile plus its label.
LABELS = 10_000


def is_blank(gene: Column | str) -> Column:
    """Whether a gene is a control that targets nothing."""
    c = F.col(gene) if isinstance(gene, str) else gene
    return c.contains("notarget") | F.lower(c).contains("blank")


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def unit(code: Column) -> Column:
    """The vector scaled to length one; null components for a zero vector."""
    norm = F.sqrt(F.aggregate(code, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.transform(code, lambda v: F.try_divide(v.cast("double"), norm))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, v: s + v)


def pixel(v: Column, drift: Column, scale: int = 1, flip: bool = True, side: int = PIXELS) -> Column:
    """Mask index of a coordinate: drift added, rounded half to even, scaled down, flipped, and held below the side. A negative index is in no cell."""
    at = F.floor(F.rint(v + drift) / scale)
    at = side - at if flip else at
    return F.least(at, F.lit(side - 1)).cast("long")


def z_slice(z: Column, step: float = Z_STEP) -> Column:
    return (F.rint(z) / step).cast("int")


def cell_id(fov: Column, label: Column) -> Column:
    """fov * 10000 + label; 0 for the background and for labels that are a multiple of 10000."""
    full = fov.cast("long") * LABELS + F.coalesce(label, F.lit(0)).cast("long")
    return F.when(F.pmod(full, F.lit(LABELS)) == 0, F.lit(0).cast("long")).otherwise(full)


def barcode_global_xy(x: Column, y: Column, pos_x: Column, pos_y: Column) -> tuple[Column, Column]:
    """Stage coordinates of a molecule: the y axis is flipped, and the stage's axes are swapped."""
    return TILE * x / PIXELS + pos_y, TILE * (PIXELS - y) / PIXELS + pos_x


def cell_global_xy(x: Column, y: Column, pos_x: Column, pos_y: Column) -> tuple[Column, Column]:
    """Stage coordinates of a cell at mask column x and row y: not flipped, and the stage's first axis runs against the mask's rows."""
    return TILE * x / PIXELS + pos_y, TILE * y / PIXELS - pos_x


def colour(bit: Column, colours: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in colours]), (F.pmod(bit - 1, F.lit(len(colours))) + 1).cast("int"))


def hyb_round(bit: Column, colours: list[str]) -> Column:
    return F.floor((bit - 1) / len(colours)).cast("int") + 1


def error_name(error_type: Column) -> Column:
    return F.when(error_type == 0, "Correct").when(error_type == -1, "1->0").when(error_type == 1, "0->1")


def overlap_bounds(diff: Column, side: float = TILE, trim: bool = False, pixels: int = PIXELS) -> tuple[Column, Column]:
    """(start, stop) of the strip that a tile shares with one `diff` away; null is open. stop counts from the far edge (negative).

    With trim, the strip is the half of the overlap that the tile gives up.
    """
    by = F.when(diff > 0, (diff + side) / 2).otherwise((diff - side) / 2) if trim else diff
    at = (pixels * by / side).cast("int")
    whole = diff.cast("int") == 0
    return F.when(~whole & (diff > 0), at), F.when(~whole & (diff < 0), at)
