"""Boxes in column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.numbers import fixed, to_double
from tagloom.functions.text import bound

# Lens distortion presets (k1, k2) and focal length as a share of the longer side.
LENS = {"weak": (-0.10, 0.00), "medium": (-0.25, 0.05), "strong": (-0.45, 0.15)}
FOCAL = 0.55

Box = tuple[Column, Column, Column, Column]


def iou(a: Box, b: Box) -> Column:
    """Overlap over union; 0 without positive overlap."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    inner = w * h
    return F.when((w <= 0) | (h <= 0), 0.0).otherwise(inner / F.greatest(area(a) + area(b) - inner, F.lit(1e-9)))


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def touches_edge(b: Box, width: Column, height: Column, margin: float = 3.0) -> Column:
    return (b[0] < margin) | (b[1] < margin) | (b[2] > width - margin) | (b[3] > height - margin)


def padded(b: Box, width: Column, height: Column, pad_x: float = 0.25, pad_y: float = 0.10) -> Column:
    """Whole-pixel crop with padding, within the frame; null if nothing is left."""
    w, h = b[2] - b[0], b[3] - b[1]
    x1, y1 = F.greatest(F.lit(0), (b[0] - pad_x * w).cast("int")), F.greatest(F.lit(0), (b[1] - pad_y * h).cast("int"))
    x2, y2 = F.least(width.cast("int"), (b[2] + pad_x * w).cast("int")), F.least(height.cast("int"), (b[3] + pad_y * h).cast("int"))
    return F.when((x2 > x1) & (y2 > y1), F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))


def clamped(b: Box, width: Column, height: Column) -> Box:
    inside = lambda v, most: F.greatest(F.lit(0.0), F.least(v, most.cast("double")))
    return inside(b[0], width), inside(b[1], height), inside(b[2], width), inside(b[3], height)


def to_label(b: Box, width: Column, height: Column) -> Column:
    """Normalised centre and size of a box, clamped to the frame."""
    x1, y1, x2, y2 = clamped(b, width, height)
    return F.struct(((x1 + x2) / 2 / width).alias("cx"), ((y1 + y2) / 2 / height).alias("cy"), ((x2 - x1) / width).alias("w"), ((y2 - y1) / height).alias("h"))


def percent_to_label(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Normalised centre and size from a corner and size in per cent."""
    return F.struct(((x + w / 2) / 100).alias("cx"), ((y + h / 2) / 100).alias("cy"), (w / 100).alias("w"), (h / 100).alias("h"))


def from_label(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return (cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height


def box_key(b: Box) -> Column:
    """Coordinates to one decimal joined by ``_``; one that can't be read is an empty part."""
    part = lambda c: F.coalesce(bound(to_double(c), lambda n: fixed(n, 1)), F.lit(""))
    return F.concat_ws("_", *map(part, b))


def distorted(b: Box, width: Column, height: Column, strength: str = "medium") -> Column:
    """Bounding rectangle of a box's corners seen through a wide lens, within the frame.

    A point at distance r from the centre (in focal lengths) moves to the
    distance t (1 + k1 t^2 + k2 t^4) with t = atan(r).
    """
    k1, k2 = LENS[strength]
    f = F.greatest(width, height) * FOCAL
    xs, ys = [], []
    for x, y in ((b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])):
        u, v = (x - width / 2) / f, (y - height / 2) / f
        r = F.sqrt(u * u + v * v)
        t = F.atan(r)
        scale = F.when(r > 1e-8, t * (1 + k1 * t * t + k2 * t * t * t * t) / r).otherwise(1.0)
        xs.append(u * scale * f + width / 2)
        ys.append(v * scale * f + height / 2)
    low = lambda c: F.greatest(F.lit(0.0), F.least(*c))
    high = lambda c, most: F.least(most.cast("double"), F.greatest(*c))
    return F.struct(low(xs).alias("x1"), low(ys).alias("y1"), high(xs, width).alias("x2"), high(ys, height).alias("y2"))


def resized(width: Column, height: Column, most: int) -> Column:
    """Size with the longer side at ``most``, never enlarged."""
    s = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))
    return F.struct((width * s).cast("int").alias("width"), (height * s).cast("int").alias("height"))


def rotated(width: Column, height: Column, degrees: int) -> Column:
    """Size after a rotation by a multiple of 90 degrees."""
    turn = math.remainder(degrees, 180) != 0
    return F.struct((height if turn else width).alias("width"), (width if turn else height).alias("height"))
