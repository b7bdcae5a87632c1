"""Milliseconds and their written forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def clock(ms: Column | str, point: str = ",") -> Column:
    """HH:MM:SS,mmm (or another point); hours grow past two digits."""
    m = col(ms).cast("long")
    # Whole-number maths: a float path would lose a millisecond on many values.
    part = lambda size, wrap: F.pmod(F.floor(m / size), F.lit(wrap))
    return F.format_string(f"%02d:%02d:%02d{point}%03d", F.floor(m / 3_600_000), part(60_000, 60), part(1000, 60), F.pmod(m, F.lit(1000)))


def clock_of_seconds(seconds: Column | str) -> Column:
    """The same for seconds as a double, to the nearest millisecond."""
    return clock(F.rint(col(seconds) * 1000).cast("long"))


def ass_ms(text: Column | str) -> Column:
    """Milliseconds of H:MM:SS.cc; the digits after the point count ten each, however many. Null if it isn't a time."""
    t = F.split(F.trim(col(text)), ":")
    last = F.split(F.try_element_at(t, F.lit(3)), r"\.")
    num = lambda c: c.try_cast("long")
    fraction = F.when(F.size(last) > 1, num(F.try_element_at(last, F.lit(2)))).otherwise(0)
    ms = ((num(F.try_element_at(t, F.lit(1))) * 60 + num(F.try_element_at(t, F.lit(2)))) * 60 + num(F.try_element_at(last, F.lit(1)))) * 1000
    return F.when(F.size(t) == 3, ms + fraction * 10)


def srt_ms(text: Column | str) -> Column:
    """Milliseconds of HH:MM:SS,mmm (a point will do); null if it isn't a time."""
    p = r"^\s*(\d+):(\d+):(\d+)[,.](\d+)\s*$"
    g = [F.regexp_extract(col(text), p, i).try_cast("long") for i in (1, 2, 3, 4)]
    return ((g[0] * 60 + g[1]) * 60 + g[2]) * 1000 + g[3]
