"""Numeric expressions on activities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: energy per metre for activities with a distance.
CALORIES_PER_METRE = 0.04


def kilometres(metres: Column) -> Column:
    return (metres / F.lit(1000.0)).cast("double")


def rounded_kilometres(metres: Column) -> Column:
    """One decimal, ties away from zero; a missing distance reads as 0."""
    return F.round(kilometres(F.coalesce(metres, F.lit(0))), 1)


def average_speed(metres: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, metres / seconds).otherwise(F.lit(0.0))


def calories(metres: Column, seconds: Column) -> Column:
    """From distance where there is one, otherwise a tenth of the moving time."""
    by_distance = F.floor(metres * F.lit(CALORIES_PER_METRE))
    return F.when(metres > 0, by_distance).otherwise(F.floor(seconds / 10)).cast("int")
