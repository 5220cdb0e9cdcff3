"""Flatten nested arrays.

``explode`` (not ``explode_outer``): NULL and empty arrays give no row, a NULL
element gives one row of NULLs. Chained explodes are narrow (no shuffle), and
Catalyst prunes the scan to the nested fields actually read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_array(df: DataFrame, array_col: str | Column, alias: str, keep: Sequence[str | Column] = ()) -> DataFrame:
    """G1: one row per element of ``array_col`` next to the ``keep`` columns."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*keep, F.explode(arr).alias(alias))


# The fields of the readings shape, outermost first.
STATION, SENSOR, DAY, VALID = "id_weatherstation", "id_weatherstationsensor", "observation_date", "is_validated"
STATISTICS = ("mean", "min", "max", "total")


def daily_readings(
    current: DataFrame, station: str = STATION, sensor: str = SENSOR, day: str = DAY, valid: str = VALID,
    statistics: Sequence[str] = STATISTICS, levels: Sequence[str] = ("sensors", "dates", "values"),
) -> DataFrame:
    """G2 on the readings shape: station → sensor → validated date → values.

    ``levels`` names the arrays of structs: ``sensors`` (with ``sensor`` and ``dates``), ``dates`` (with ``day``,
    ``valid`` and ``values``) and ``values`` (with the ``statistics``). The output is flat: station, sensor, day,
    statistics. Only dates whose ``valid`` is true are expanded.
    """
    first, second, third = levels
    sensors = explode_array(current, first, "s", [station])
    dates = explode_array(sensors, f"s.{second}", "d", [station, F.col(f"s.{sensor}").alias(sensor)])
    values = explode_array(
        dates.filter(F.col(f"d.{valid}")), f"d.{third}", "v", [station, sensor, F.col(f"d.{day}").alias(day)])
    return values.select(station, sensor, day, *[F.col(f"v.{f}").alias(f) for f in statistics])
