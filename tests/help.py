"""Small frames and straightforward answers to compare with."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1)
MINUTE = timedelta(minutes=1)
HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
EVENT = "k string, t timestamp, v double, s string"


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def random_events(n: int, seed: int, minutes: int = 600, keys: int = 4) -> list[tuple]:
    """Events with one key that has half the rows, ties, null keys, times and values."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(keys)}"
        key = None if rng.random() < 0.03 else key
        time = at(rng.randrange(minutes) + rng.choice([0, 0.5])) if rng.random() > 0.03 else None
        value = float(rng.randrange(100)) if rng.random() > 0.1 else None
        name = rng.choice("abcdefg") if rng.random() > 0.1 else None
        rows.append((key, time, value, name))
    return rows


def floor(time: datetime, interval: timedelta) -> datetime:
    return datetime(1970, 1, 1) + ((time - datetime(1970, 1, 1)) // interval) * interval


def window_rows(events, key, low, high, closed="left"):
    """Events of a key in [low, high), or (low, high] when closed on the right."""
    if key is None or high is None:
        return []
    if closed == "left":
        return [e for e in events if e[0] == key and e[1] is not None and low <= e[1] < high]
    return [e for e in events if e[0] == key and e[1] is not None and low < e[1] <= high]


def aggregate(rows, function, size=None, column=2):
    values = [r[column] for r in rows if r[column] is not None]
    if function == "count":
        return len(values)
    if function in ("distinct", "approx_distinct"):  # sketches of a few values are exact
        return len(set(values))
    if function == "last_distinct":
        newest = {}
        for r in rows:
            if r[column] is not None:
                newest[r[column]] = max(newest.get(r[column], r[1]), r[1])
        return [v for _, v in sorted(((t, v) for v, t in newest.items()), reverse=True)[:size]] or None
    if function == "last":
        newest = sorted(((r[1], r[column]) for r in rows if r[column] is not None), reverse=True)
        return [v for _, v in newest[:size]] or None
    if not values:
        return None
    if function in ("min", "max"):
        return min(values) if function == "min" else max(values)
    return sum(values) if function == "sum" else sum(values) / len(values)


def same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        return (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6)
    return a == b


def plain(df):
    """Rows as tuples with zone-less times, in an order that does not matter."""
    from tidemark.sources.tables import zoneless

    return sorted((tuple(r) for r in zoneless(df).collect()), key=repr)
