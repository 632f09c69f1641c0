"""catchment: a Spark-native hydro/weather lakehouse library.

Landed hourly river-gauge and weather-station readings are validated,
de-duplicated and upserted into day-partitioned bronze tables, station
metadata is kept as SCD2 validity intervals, long series are pivoted into
wide hourly silver tables, levels are corrected with the station version
valid at reading time, every gauge is matched to its nearest weather
stations, and both sides are joined into the gold analysis table.
"""

from .session import configure, get_spark

__all__ = ["configure", "get_spark"]
