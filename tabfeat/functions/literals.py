"""Fitted numbers as literal columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(values: Sequence[float]) -> Column:
    """A constant array of doubles, parsed in one call however long it is."""
    def text(v: float) -> str:
        return f"{float(v)!r}D" if math.isfinite(v) else f"double('{v}')"

    return F.expr(f"array({', '.join(text(v) for v in values)})")
