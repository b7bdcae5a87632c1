"""Parts of slash-separated paths, as the usual path libraries cut them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

_TAIL = r"(?s)^(.+)(\.[^.]+)$"


def basename(path: Column | str) -> Column:
    return F.substring_index(F.rtrim(col(path), F.lit("/")), "/", -1)


def parent(path: Column | str) -> Column:
    """The folder; empty for a bare name."""
    return F.regexp_extract(col(path), r"(?s)^(.*)/[^/]*$", 1)


def stem(path: Column | str) -> Column:
    """The name before its last dot; a leading or final dot doesn't count."""
    name = basename(path)
    return F.when(name.rlike(_TAIL), F.regexp_extract(name, _TAIL, 1)).otherwise(name)


def suffix(path: Column | str) -> Column:
    return F.regexp_extract(basename(path), _TAIL, 2)


def with_suffix(path: Column | str, new: str) -> Column:
    """The path with another ending, as for a companion file."""
    folder = parent(path)
    return F.concat(F.when(col(path).contains("/"), F.concat(folder, F.lit("/"))).otherwise(""), stem(path), F.lit(new))


def absolute(path: Column | str, root: str) -> Column:
    """The path itself if it begins with a slash or a scheme, else below ``root``."""
    whole = col(path).startswith("/") | col(path).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:/")
    return F.when(whole, col(path)).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), col(path)))


def relative(path: Column | str, root: str) -> Column:
    """The path below ``root``; paths elsewhere stay as they are."""
    base = root.rstrip("/") + "/"
    return F.when(col(path).startswith(base), F.substring(col(path), len(base) + 1, 1 << 30)).otherwise(col(path))
