from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import alert_condition
from ..schemas import MAX_RPM, MAX_SPEED


def alerts(df: DataFrame, max_speed: int = MAX_SPEED, max_rpm: int = MAX_RPM) -> DataFrame:
    """Keep the enriched events that are alerts.

    The condition reads event columns only. Over a lookup join Spark therefore
    applies it before the join.
    """
    return df.where(alert_condition(max_speed, max_rpm))
