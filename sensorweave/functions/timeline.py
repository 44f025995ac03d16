"""Time arithmetic on epoch microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US = 1_000_000


def micros(ts: Column | str) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(us)


def floor_us(us: Column, step_us: int) -> Column:
    """Largest multiple of the step at or below `us`, also before the epoch."""
    return us - F.pmod(us, F.lit(step_us))


def ceil_us(us: Column, step_us: int) -> Column:
    return us + F.pmod(-us, F.lit(step_us))


def round_us(us: Column, step_us: int) -> Column:
    """Nearest multiple of the step; a tie goes to the even multiple. Integer arithmetic only."""
    low = floor_us(us, step_us)
    twice = (us - low) * 2
    odd = F.pmod(low, F.lit(2 * step_us)) != 0
    up = (twice > step_us) | ((twice == step_us) & odd)
    return F.when(up, low + step_us).otherwise(low)


def round_slot(ts: Column, step_s: int) -> Column:
    return from_micros(round_us(micros(ts), step_s * US))


def floor_slot(ts: Column, step_s: int) -> Column:
    return from_micros(floor_us(micros(ts), step_s * US))
