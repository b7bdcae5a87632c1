"""Dataset manifests: parsing, checking against the files there, reference clips, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import parent
from ..functions.text import half_even, strip
from ..sinks.written import written


def parse(lines: DataFrame) -> DataFrame:
    """(line_no, name, text, normalized, status) from (line_no, value): fields parted by bars, without any quoting.

    status: `empty`, `malformed` (fewer than two fields) or `ok`.  The third field is the
    normalized text even if it is empty; without one the text stands for it.
    """
    f = F.split("value", r"\|")
    field = lambda i: strip(F.try_element_at(f, F.lit(i)))
    status = F.when(F.col("value") == "", "empty").when(F.size(f) < 2, "malformed").otherwise("ok")
    return lines.select(
        "line_no", field(1).alias("name"), field(2).alias("text"), F.when(F.size(f) >= 3, field(3)).otherwise(field(2)).alias("normalized"), status.alias("status")
    )


def resolve(rows: DataFrame, files: DataFrame, ext: str = ".wav", root: str = "wavs") -> DataFrame:
    """``rows`` with ``audio``: the path of name + ``ext``, else of name, below ``root``; status `missing` where neither is in ``files`` (path).

    Names are joined, not looked up on a file system; an empty or null name is missing.
    Line numbers need not be unique, so rows of several manifests can be resolved together.
    A column ``audio`` of ``rows`` is replaced.

    Each file is listed under the names that ask for it, so rows are matched once. Rows
    that ask for nothing are spread by their hash instead of meeting under one null key. The names are
    written: Spark then broadcasts them if they are few, and else may split the rows of a name that many share.
    """
    ext = ext if ext.startswith(".") else f".{ext}"
    bare = F.substr("path", F.lit(len(root) + 2))
    whole = F.when(F.endswith("path", F.lit(ext)), F.substr(bare, F.lit(1), F.length(bare) - len(ext)))
    names = F.explode(F.array(F.struct(bare.alias("_name"), F.lit(False).alias("_ext")), F.struct(whole.alias("_name"), F.lit(True).alias("_ext"))))
    listed = files.where(F.startswith("path", F.lit(f"{root}/"))).select(names.alias("x")).select("x.*").where("_name <> ''")
    # _spread is written with the names: as a constant it would be taken out of the join's keys.
    known = written(listed.groupBy("_name").agg(F.max("_ext").alias("_ext")).withColumn("_spread", F.lit(0).cast("long")))
    asks = F.coalesce((F.col("status") == "ok") & (F.col("name") != ""), F.lit(False))
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind])
    want = rows.withColumns({"_name": F.when(asks, F.col("name")).otherwise(""), "_spread": F.when(asks, F.lit(0).cast("long")).otherwise(hashed)})
    audio = F.when(F.col("_ext").isNotNull(), F.concat(F.lit(f"{root}/"), "_name", F.when(F.col("_ext"), ext).otherwise("")))
    out = want.join(known, ["_name", "_spread"], "left").select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() != "audio"], audio.alias("audio"))
    return out.withColumn("status", F.when((F.col("status") == "ok") & F.col("audio").isNull(), "missing").otherwise(F.col("status")))


def report(rows: DataFrame) -> DataFrame:
    """(status, n)."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def _draw(seed: int, purpose: str, key: tuple[str, ...]) -> Column:
    return F.md5(F.concat_ws("/", F.lit(f"{seed}/{purpose}"), *[F.col(k).cast("string") for k in key]))


CELL_LINES = 1 << 16  #: line numbers of a folder whose rows are ranked together


def _digits(rows: int) -> int:
    """Hexadecimal digits of a draw that part ``rows`` rows into cells of about ``CELL_LINES``."""
    return next(d for d in range(1, 33) if rows <= CELL_LINES << 4 * d)


def _ranked(rows: DataFrame, name: str, cell: Column, order: list[Column]) -> DataFrame:
    """``rows`` with their rank from 1 in ``order`` within dir, ``cell`` being a coarser form of that order, and dir's size.

    Rows are ranked within cells, and running totals of the cells' counts added.
    """
    celled = rows.drop("size").withColumn("_cell", cell)
    before = Window.partitionBy("dir").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # one row a cell
    total = F.sum("count").over(Window.partitionBy("dir"))
    starts = celled.groupBy("dir", "_cell").count().select("dir", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"), total.alias("size"))
    inner = Window.partitionBy("dir", "_cell").orderBy(*order)
    return celled.withColumn(name, F.row_number().over(inner)).join(starts, ["dir", "_cell"]).withColumn(name, F.col(name) + F.col("_start")).drop("_cell", "_start")


def references(samples: DataFrame, ratio: float = 0.4, allow_self: bool = False, seed: int = 0, key: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``samples`` (line_no, audio, ...) with dir, pos (from 0 in the folder) and ref_audio.

    In each folder round-half-even(n * ratio) samples, drawn by a hash, get another
    sample of the folder as a reference: a uniform partner at another place, or any
    place with ``allow_self`` or where there is but one.  Samples come in the order of ``key``, which
    tells them apart and ends with a number: (`line_no`) of one manifest, or its file and `line_no`
    of several.  The draw depends on seed and key alone, so it is the same on any cluster.

    Only keys and paths are ranked, in ranges of numbers and of draws, so a folder that
    holds most rows is ranked by many tasks; the other columns meet the result once.
    Rows that share a key are an error.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("ratio lies between 0 and 1")
    base = samples.withColumn("dir", parent("audio"))
    order = [F.col(k) for k in key]
    cell = F.struct(*order[:-1], F.floor(order[-1] / CELL_LINES).alias("_range"))
    ranked = _ranked(base.select(*key, "dir", "audio"), "pos", cell, order)
    ranked = written(ranked.select(*key, "dir", "audio", (F.col("pos") - 1).cast("long").alias("pos"), "size"))
    if ranked.groupBy(*key).count().where("count > 1").head(1):
        raise ValueError(f"samples share a {', '.join(key)}; name what tells them apart as key")
    draw = _draw(seed, "pick", key)
    placed = _ranked(ranked.select(*key, "dir", "pos", "size"), "turn", F.substring(draw, 1, _digits(ranked.count())), [draw, *order])
    h = F.conv(F.substring(_draw(seed, "partner", key), 1, 12), 16, 10).cast("long")
    anyone = F.lit(allow_self) | (F.col("size") == 1)
    partner = F.when(anyone, h % F.col("size")).otherwise((F.col("pos") + 1 + h % F.greatest(F.col("size") - 1, F.lit(1))) % F.col("size"))
    picked = placed.where(F.col("turn") <= F.least(F.col("size"), half_even(F.col("size") * ratio))).select(*key, F.col("dir").alias("_d"), partner.alias("_p"))
    other = ranked.select(F.col("dir").alias("_d"), F.col("pos").alias("_p"), F.col("audio").alias("ref_audio"))
    chosen = picked.join(other, ["_d", "_p"]).select(*key, "ref_audio")
    found = ranked.select(*key, "pos").join(chosen, [*key], "left")
    return base.join(found, [*key]).select(*[c for c in samples.columns], "dir", "pos", "ref_audio")


def summary(samples: DataFrame, ratio: float = 0.4) -> DataFrame:
    """(total, folders, refs, actual_pct, target_pct)."""
    n = F.count("*")
    refs = F.count("ref_audio")
    return samples.agg(
        n.alias("total"),
        F.count_distinct("dir").alias("folders"),
        refs.alias("refs"),
        F.when(n > 0, 100.0 * refs / n).otherwise(0.0).alias("actual_pct"),
        F.lit(100.0 * ratio).alias("target_pct"),
    )


def json_lines(samples: DataFrame) -> Column:
    """One record as JSON, keys audio, text (the normalized one) and, if there is one, ref_audio, with a blank after colon and comma."""
    q = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    ref = F.when(F.col("ref_audio").isNotNull(), F.concat(F.lit(', "ref_audio": '), q("ref_audio"))).otherwise("")
    return F.concat(F.lit('{"audio": '), q("audio"), F.lit(', "text": '), q("normalized"), ref, F.lit("}"))


def ordered(samples: DataFrame, shuffle: bool = True, seed: int = 0, key: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """By folder and key, or in an order drawn from the seed; a range-partitioned sort either way."""
    return samples.orderBy(_draw(seed, "order", key), *key) if shuffle else samples.orderBy("dir", *key)


def places(samples: DataFrame, seed: int = 0, key: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``samples`` with place long: their numbers from 1 in the shuffled order of ``ordered``, for sinks that keep no order.

    Keys alone are ranked, in ranges of the draw, so no task sorts all rows; they must be unique.
    """
    draw = _draw(seed, "order", key)
    keyed = written(samples.select(F.lit("").alias("dir"), *key))
    ranked = _ranked(keyed, "place", F.substring(draw, 1, _digits(keyed.count())), [draw, *[F.col(k) for k in key]])
    return samples.join(ranked.select(*key, F.col("place").cast("long").alias("place")), [*key])
