"""Column helpers: time arithmetic, report strings, ordered tag rules.

All of these return JVM-side Column expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(duration: str | int) -> int:
    """'3 seconds' / '15 minutes' / '1 hour' / int microseconds -> microseconds."""
    if isinstance(duration, int):
        return duration
    total = 0
    parts = duration.strip().lower().split()
    if len(parts) % 2:
        raise ValueError(f"bad duration {duration!r}")
    for i in range(0, len(parts), 2):
        n, unit = float(parts[i]), parts[i + 1].rstrip("s")
        if unit not in _UNITS_US:
            raise ValueError(f"bad duration unit in {duration!r}")
        total += int(n * _UNITS_US[unit])
    return total


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column
    (NTZ is read as UTC, which is the session time zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast(T.TimestampType()))


def epoch_ms(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c.cast(T.TimestampType()))


def window_report(start: str | Column, end: str | Column, n: str | Column,
                  label: str | Column) -> Column:
    """``[start_ms - end_ms] - n label``: the window report line.  A Column as
    ``label`` gives each row its own, e.g. ``concat('events of type ', event_type)``."""
    n = F.col(n) if isinstance(n, str) else n
    return F.format_string("[%d - %d] - %d %s", epoch_ms(start), epoch_ms(end),
                           n, F.lit(label) if isinstance(label, str) else label)


def key_report(key: str | Column, text: str | Column, prefix: str = "User ") -> Column:
    """``User <key> - <text>``: the report line of per-key state."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(prefix), F.coalesce(key.cast("string"), F.lit("null")), F.lit(" - "), F.coalesce(text.cast("string"), F.lit("null")))


def tag(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """First matching rule wins (``when(...).when(...).otherwise(default)``)."""
    expr = None
    for pred, name in rules:
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def divisible(c: str | Column, d: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c % d) == 0


def join_ids(arr: Column, sep: str = ",") -> Column:
    """Array of values -> 'a,null,c': a null entry keeps its place (a null array
    stays null)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep, "null")


def player_identity(player_id: str | Column = "player_id", nickname: str | Column = "nickname") -> Column:
    """``player|<id>|<nickname>``, or ``player|<id>`` when the nickname is null
    (``concat_ws`` skips nulls, so one expression covers both event kinds)."""
    p = F.col(player_id) if isinstance(player_id, str) else player_id
    n = F.col(nickname) if isinstance(nickname, str) else nickname
    return F.concat_ws("|", F.lit("player"), p, n)


def one_of(c: str | Column, allowed: Sequence[str]) -> Column:
    """True when the value is null or one of ``allowed`` (an enum check)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.isin(list(allowed))
