"""Time expressions on a regular grid."""

from __future__ import annotations

import math
import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def grid_us(grid: str | timedelta) -> int:
    """Length of a grid step such as ``"10 minutes"`` in microseconds."""
    if isinstance(grid, timedelta):
        return grid // timedelta(microseconds=1)
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", grid)
    if not match:
        raise ValueError(f"unknown grid step {grid!r}")
    return int(match[1]) * _UNIT_US[match[2]]


def grid_minutes(grid: str | timedelta) -> float:
    return grid_us(grid) / _UNIT_US["minute"]


def whole_div(value: Column, by: int) -> Column:
    """Floor division, also below zero; the dividend is exact so no rounding occurs."""
    return ((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("long")


def step_index(ts: Column, grid: str | timedelta) -> Column:
    """Number of the grid step that holds ``ts``, counted from the epoch."""
    return whole_div(F.unix_micros(ts), grid_us(grid))


def step_start(index: Column, grid: str | timedelta) -> Column:
    return F.timestamp_micros(index * F.lit(grid_us(grid)))


def floor_to_grid(ts: Column, grid: str | timedelta) -> Column:
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(grid_us(grid))))


def shift(ts: Column, micros: int) -> Column:
    """``ts`` moved by a fixed number of microseconds."""
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(micros))


def shift_steps(ts: Column, steps: int, grid: str | timedelta) -> Column:
    return shift(ts, steps * grid_us(grid))


# Calendar parts are counted from the epoch, so they are UTC in every session.


def utc_date(ts: Column) -> Column:
    return F.date_from_unix_date(whole_div(F.unix_micros(ts), _UNIT_US["day"]).cast("int"))


def hour_of_day(ts: Column) -> Column:
    return F.pmod(whole_div(F.unix_micros(ts), _UNIT_US["hour"]), F.lit(24)).cast("int")


def day_of_week(ts: Column) -> Column:
    """Monday is 0; the epoch was a Thursday."""
    return F.pmod(whole_div(F.unix_micros(ts), _UNIT_US["day"]) + 3, F.lit(7)).cast("int")


def iso_utc(ts: Column) -> Column:
    second = F.pmod(whole_div(F.unix_micros(ts), _UNIT_US["second"]), F.lit(86_400))
    parts = [whole_div(second, 3600), F.pmod(whole_div(second, 60), F.lit(60)), F.pmod(second, F.lit(60))]
    clock = F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])
    return F.when(ts.isNotNull(), F.concat(utc_date(ts).cast("string"), F.lit("T"), clock, F.lit("Z")))


def naive_as_utc(column: str) -> Column:
    """A timestamp column without zone, read as UTC."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{column}`))")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def daily_load_factor(hour: Column) -> Column:
    """Expected load over the day: low at night, highest in the early afternoon."""
    wave = F.sin((hour.cast("double") - 7.0) / 24.0 * (2 * math.pi))
    return F.lit(0.3) + F.lit(0.7) * (F.lit(0.5) + F.lit(0.5) * wave)


def age_seconds(newest: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(newest)) / F.lit(1_000_000)


def is_live(age: Column, cadence_seconds: float) -> Column:
    return age < F.lit(4.0 * cadence_seconds)
