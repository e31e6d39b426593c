"""Latest batch selection.

Keeps the rows whose stamp equals the frame's maximum stamp; NULL stamps are
never kept and an all-NULL table gives no rows. RAW's newest month is found from its
folder names before (``layers.newest_month``), so only that month is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch(raw: DataFrame, stamp: str = "partition_time") -> DataFrame:
    newest = raw.select(F.max(stamp)).scalar()
    return raw.where(F.col(stamp) == newest)
