"""Column expressions for plane geometry and kinematics."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = math.pi


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ahead(dx: Column, dy: Column, heading: Column) -> Column:
    """Component along the heading."""
    return dx * F.cos(heading) + dy * F.sin(heading)


def aside(dx: Column, dy: Column, heading: Column) -> Column:
    """Component to the left of the heading."""
    return dy * F.cos(heading) - dx * F.sin(heading)


def speed(vx: Column | str = "vx", vy: Column | str = "vy") -> Column:
    return F.sqrt(col(vx) * col(vx) + col(vy) * col(vy))


def wrapped_once(a: Column, b: Column) -> Column:
    """|a - b|, taken from the full turn once where it exceeds half a turn."""
    d = F.abs(a - b)
    return F.when(d > PI, 2 * PI - d).otherwise(d)


def wrapped(a: Column, b: Column) -> Column:
    """The angle between two headings, whatever turns they hold."""
    return F.abs(F.atan2(F.sin(a - b), F.cos(a - b)))


def yaw(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Heading of a unit quaternion."""
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))
