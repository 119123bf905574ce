"""Tick series that sit on the edges at which bars differ between careless implementations; the same seed gives the same ticks."""

import datetime as dt
import random
from decimal import Decimal

Series = tuple[list[tuple[dt.datetime, Decimal, Decimal]], int]
T0 = dt.datetime(2025, 1, 6, tzinfo=dt.UTC)


def sums_that_meet_the_threshold(seed: int, threshold: int, n_bars: int) -> Series:
    """Quantities whose sum since the last close is exactly the threshold at each bar's last tick, to the last digit; a rest that closes nothing. And the bars there must be."""
    r, out, at = random.Random(seed), [], T0
    for _ in range(n_bars):
        left = Decimal(threshold)
        while left > 0:
            q = min(left, Decimal(r.randrange(1, threshold * 10**7)) / Decimal(10**8))
            at += dt.timedelta(milliseconds=r.randrange(1, 500))
            out.append((at, Decimal(r.randrange(100, 200)), q))
            left -= q
    out.append((at + dt.timedelta(seconds=1), Decimal(150), Decimal(threshold) - Decimal("0.00000001")))
    return out, n_bars


def ticks_at_the_ends_of_windows(seed: int, seconds: int, n_bars: int) -> Series:
    """In each window a tick at its first microsecond and one at its last; the next window's first is exactly at the end of the one before."""
    r, out = random.Random(seed), []
    for k in range(n_bars + 1):
        start = T0 + dt.timedelta(seconds=k * seconds)
        for t in (start, start + dt.timedelta(seconds=seconds, microseconds=-1)):
            out.append((t, Decimal(r.randrange(1, 1000)), Decimal(1)))
    return out, n_bars


def notionals_between_digits(seed: int, threshold: int, n_bars: int) -> Series:
    """Before each bar's last tick the products add up to one unit of the sixteenth digit less than the threshold; whatever rounds up closes a tick early."""
    r, out, at = random.Random(seed), [], T0
    unit = Decimal("0.00000001")
    for _ in range(n_bars):
        part = Decimal(r.randrange(1, threshold))
        for p, q in ((part, Decimal(1)), (Decimal(threshold) - part - unit, Decimal(1)), (unit, 1 - unit), (unit, unit)):
            at += dt.timedelta(milliseconds=r.randrange(1, 2000))
            out.append((at, p, q))
    return out, n_bars
