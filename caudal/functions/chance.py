"""Chance that depends on the row alone.

``rand`` and ``randomSplit`` depend on how rows are spread over partitions, so a
task that runs again after a lost executor may draw other numbers than the first
time. A digest of the row's own key gives the same number wherever and however
often the row is computed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) for the given key columns; null keys count as empty text."""
    text = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
