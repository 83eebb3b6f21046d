"""Court geometry as column expressions, in feet; hoop side is a boolean column (true: left)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Court and line measures in feet.
LENGTH, WIDTH = 94.0, 50.0
HOOP_LEFT_X, HOOP_Y = 5.25, 25.0
THREE_RADIUS, CORNER_OFFSET, CORNER_LENGTH = 23.75, 22.0, 14.0
LANE_WIDTH, LANE_LENGTH = 16.0, 19.0


def hoop_x(left: Column) -> Column:
    return F.when(left, HOOP_LEFT_X).otherwise(LENGTH - HOOP_LEFT_X)


def from_baseline(x: Column, left: Column) -> Column:
    return F.when(left, x).otherwise(LENGTH - x)


def is_three(x: Column, y: Column, left: Column) -> Column:
    """Beyond the arc, or beside the corner lines."""
    aside = F.abs(y - HOOP_Y)
    return ((from_baseline(x, left) <= CORNER_LENGTH) & (aside >= CORNER_OFFSET)) | (F.hypot(x - hoop_x(left), aside) >= THREE_RADIUS)


def to_left_half(x: Column, y: Column, left: Column) -> tuple[Column, Column]:
    """Turned by half a turn where the attack goes right."""
    return F.when(left, x).otherwise(LENGTH - x), F.when(left, y).otherwise(WIDTH - y)


def in_paint(x: Column, y: Column, left: Column) -> Column:
    return (from_baseline(x, left) <= LANE_LENGTH) & (F.abs(y - HOOP_Y) <= LANE_WIDTH / 2)


def in_front_half(x: Column, left: Column) -> Column:
    return from_baseline(x, left) < LENGTH / 2


def near_line(x: Column, y: Column, margin: float) -> Column:
    """Out of bounds or within margin of a line."""
    return (x <= margin) | (x >= LENGTH - margin) | (y <= margin) | (y >= WIDTH - margin)
