"""Display values derived per row: rounding, text, marker and bubble sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Two places, half to even, as Python's ``round`` does."""
    return F.bround(_col(c), 2)


def fmt2(c) -> Column:
    """Two-decimal text, ``f"{x:.2f}"``."""
    return F.format_string("%.2f", _col(c))


def marker_radius(magnitude, cap: float = 10.0, scale: float = 2.0) -> Column:
    """Map-marker radius, ``min(Magnitude * 2, 10)``."""
    return F.least(_col(magnitude) * F.lit(scale), F.lit(cap))


def bubble_linear(depth, scale: float = 10.0) -> Column:
    """Bubble size proportional to depth, ``Depth * 10``."""
    return _col(depth) * F.lit(scale)


def bubble_scaled(depth, lo: Column, hi: Column, smallest: float = 20.0, largest: float = 200.0) -> Column:
    """Min-max scale depth onto [smallest, largest]; all-equal input maps to smallest."""
    span = hi - lo
    return F.when(span > 0, F.lit(smallest) + F.lit(largest - smallest) * (_col(depth) - lo) / span).otherwise(
        F.lit(smallest)
    )


# Marker roles and their colours and radii on the trends map.
ROLE_COLOURS = {"most": "red", "least": "blue", "other": "orange"}
ROLE_RADII = {"most": 12, "least": 12, "other": 5}


def _by_role(role, table: dict) -> Column:
    r = _col(role)
    return (
        F.when(r == "most", F.lit(table["most"]))
        .when(r == "least", F.lit(table["least"]))
        .otherwise(F.lit(table["other"]))
    )


def role_colour(role) -> Column:
    return _by_role(role, ROLE_COLOURS)


def role_radius(role) -> Column:
    return _by_role(role, ROLE_RADII)


# Popup headings per marker role.
ROLE_HEADINGS = {"most": "Most Severe Earthquake", "least": "Least Severe Earthquake", "other": "Magnitude"}


def role_heading(role) -> Column:
    return _by_role(role, ROLE_HEADINGS)


def popup_text(magnitude, date, heading=None) -> Column:
    """Marker text ``<heading>: m | Date: d`` (plain text, no HTML)."""
    head = F.concat(_col(heading) if heading is not None else F.lit("Magnitude"), F.lit(": "), _col(magnitude).cast("string"))
    return F.concat_ws(" | ", head, F.concat(F.lit("Date: "), _col(date)))
