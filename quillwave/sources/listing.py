"""File listings as DataFrames; no file's content is read."""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import suffix, with_suffix
from ..sinks.files import store_of

LOOKUPS = 256  #: paths that a task looks up at once
WILD = re.compile(r"[*?\[]")


def listing(spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length) of the files below ``root``, their names as ``pattern`` asks (a glob)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length")


def _pattern(glob: str) -> str:
    """A glob with ``**`` as a regular expression for whole paths."""
    out = ""
    for part in re.findall(r"\*\*/|\*\*|\*|\?|\[[^\]]*\]|.", glob, re.S):
        if part[0] == "[" and len(part) > 2:
            out += "[" + part[1:-1].replace("\\", r"\\").replace("!", "^", part[1] == "!") + "]"
        else:
            out += {"**/": "(?:[^/]+/)*", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(part) or re.escape(part)
    if glob.startswith("/"):
        return f"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:/*)?/*{out.lstrip('/')}$"
    return f"^{out}$" if ":/" in glob else f"^(?:.*/)?{out}$"


def matched(files: DataFrame, patterns: list[str], distinct: bool = True) -> DataFrame:
    """(path, nth): the files of a listing (path) that each pattern names, with the pattern's number; with ``distinct`` the first one.

    All patterns are tried in one pass over the listing.
    """
    hits = F.array_compact(F.array(*[F.when(F.col("path").rlike(_pattern(p)), F.lit(i)) for i, p in enumerate(patterns)])) if patterns else F.array().cast("array<int>")
    found = files.select("path", hits.alias("hits")).where(F.size("hits") > 0)
    return found.groupBy("path").agg(F.min(F.array_min("hits")).alias("nth")) if distinct else found.select("path", F.explode("hits").alias("nth"))


def _with_scheme(spark: SparkSession, path: str) -> str:
    """A path as Spark writes it: with a scheme, that of the default file system where it has none, and single slashes."""
    if not re.match("[a-zA-Z][a-zA-Z0-9+.-]*:/", path):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        if default.startswith("file:"):
            return "file:" + os.path.abspath(path)
        path = default.rstrip("/") + "/" + path.lstrip("/")
    return re.sub("(?<=[^:/])/+", "/", re.sub("^file:/+", "file:/", path))


def _children(folder: str, as_files: tuple[str, ...]) -> Iterator[tuple[str, bool]]:
    """(path, whether it is a folder) of what is in a folder, hidden names left out; folders with the endings ``as_files`` are none."""
    store, place = store_of(folder)
    if store.get_file_info(place).type != fs.FileType.Directory:
        return
    for info in store.get_file_info(fs.FileSelector(place, recursive=False)):
        if info.base_name[0] not in "._":
            yield f"{folder.rstrip('/')}/{info.base_name}", info.type == fs.FileType.Directory and not info.base_name.endswith(as_files)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def walked(spark: SparkSession, roots: dict[str, int], as_files: tuple[str, ...] = ()) -> DataFrame:
    """(path) of the files below folders, each as many levels down as it says.

    A root's own folder is read by one task, and each of the folders in it is then walked by a
    task of its own.  Folders with the endings ``as_files`` count as files and aren't entered.
    """
    work = pa.schema([("path", pa.string()), ("depth", pa.int32())])  # a depth of 0: a file

    def one_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, depth in zip(batch.column("path").to_pylist(), batch.column("depth").to_pylist(), strict=True):
                yield _batch([(path, depth - 1 if folder else 0) for path, folder in _children(root, as_files) if not folder or depth > 1], work)

    def all_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = list(zip(batch.column("path").to_pylist(), batch.column("depth").to_pylist(), strict=True))
            files = [(path, 0) for path, depth in todo if not depth]
            todo = [x for x in todo if x[1]]
            while todo:
                folder, depth = todo.pop()
                for path, inside in _children(folder, as_files):
                    if not inside:
                        files.append((path, 0))
                    elif depth > 1:
                        todo.append((path, depth - 1))
                if len(files) > 4096:
                    yield _batch(files, work)
                    files = []
            yield _batch(files, work)

    given = spark.createDataFrame(list(roots.items()), "path string, depth int").repartition("path")
    spread = given.mapInArrow(one_level, "path string, depth int").repartition("path")
    return spread.mapInArrow(all_levels, "path string, depth int").select("path")


def looked_up(spark: SparkSession, paths: list[str], as_files: tuple[str, ...] = ()) -> DataFrame:
    """(path) of those paths that are files, or folders with the endings ``as_files``, ``LOOKUPS`` of them in one call."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch.column("paths").to_pylist():
                found = []
                for path in some:
                    store, place = store_of(path)
                    kind = store.get_file_info(place).type
                    if kind == fs.FileType.File or kind == fs.FileType.Directory and place.endswith(as_files):
                        found.append(path)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])

    parts = [(i, paths[i : i + LOOKUPS]) for i in range(0, len(paths), LOOKUPS)]
    return spark.createDataFrame(parts, "i int, paths array<string>").repartition("i").select("paths").mapInArrow(run, "path string")


def _opens(path: str) -> bool:
    """Whether tasks can read this path's store themselves."""
    try:
        store_of(path)
        return True
    except (OSError, pa.ArrowException):
        return False


def _by_reader(spark: SparkSession, folders: set[str], as_files: tuple[str, ...]) -> DataFrame:
    """(path) of the files below folders of a store that only Spark's own readers open, and of the folders above them with the endings ``as_files``."""
    found = spark.createDataFrame([], "path string")
    for folder in sorted(f for f in folders if not any(f.startswith(f"{g}/") for g in folders)):
        try:
            found = found.unionByName(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if as_files:
        parts = F.split("path", "/")
        above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
        tables = F.filter(above, lambda p: F.substring_index(p, "/", -1).rlike(f"({'|'.join(map(re.escape, as_files))})$"))
        found = found.select(F.explode(F.array_append(tables, F.col("path"))).alias("path"))
    return found


def _root(glob: str) -> tuple[str, int]:
    """The folder that a glob is fixed to, and how many levels below it its files are."""
    fixed = glob[: WILD.search(glob).start()].rpartition("/")[0]
    rest = glob[len(fixed) + 1 :]
    return fixed, 1 << 20 if "**" in rest else rest.count("/") + 1


def expand(spark: SparkSession, patterns: list[str], distinct: bool = True, literal: bool = False, as_files: tuple[str, ...] = ()) -> DataFrame:
    """(path, pos): the files of each glob in turn, sorted within it; with ``distinct`` a path keeps its first place.

    ``**`` stands for any folders.  A pattern without a file gives a warning and nothing,
    or, with ``literal``, itself as a path.  Names that begin with a dot or an underscore
    are hidden, as for all file sources.  A folder with one of the endings ``as_files`` counts as
    a file (a table written in parts), and only a pattern that spells the folder out finds what is in it.

    Plain paths are looked up together, folders that globs are fixed to are walked together, and all
    globs are matched in one pass: the number of jobs doesn't depend on that of the patterns.
    """
    whole = [_with_scheme(spark, p) for p in patterns]
    roots: dict[str, int] = {}
    for p in filter(WILD.search, whole):
        root, depth = _root(p)
        roots[root] = max(depth, roots.get(root, 0))
    plain = {i: p for i, p in enumerate(whole) if not WILD.search(p)}
    there = None
    if not all(map(_opens, {p.split("/", 3)[0] + "//" + p.split("/", 3)[2] + "/" if "://" in p else "file:/" for p in whole})):
        there = _by_reader(spark, {*roots, *(p.rpartition("/")[0] for p in plain.values())}, as_files)
    found = spark.createDataFrame([], "path string, nth int")
    if roots:
        globs = [i for i, p in enumerate(whole) if WILD.search(p)]
        numbers = F.array(*[F.lit(i) for i in globs])
        hits = matched((walked(spark, roots, as_files) if there is None else there).distinct(), [whole[i] for i in globs], distinct=False)
        if as_files:
            below = F.array(*[F.lit(len(_root(whole[i])[0]) + 2) for i in globs])[F.col("nth")]
            hits = hits.where(~F.substring("path", below, F.length("path")).rlike(f"({'|'.join(map(re.escape, as_files))})/"))
        found = found.unionByName(hits.select("path", numbers[F.col("nth")].alias("nth")))
    if plain:
        places = spark.createDataFrame([(p, i) for i, p in plain.items()], "path string, nth int")
        known = looked_up(spark, sorted(set(plain.values())), as_files) if there is None else there.distinct()
        found = found.unionByName(known.join(places, "path").select("path", "nth"))
    found = found.cache()
    missing = set(range(len(patterns))) - {r["nth"] for r in found.select("nth").distinct().collect()}  # numbers of the caller's own list
    if missing and literal:
        found = found.unionByName(spark.createDataFrame([(patterns[i], i) for i in sorted(missing)], "path string, nth int"))
    elif missing:
        some = ", ".join(patterns[i] for i in sorted(missing)[:10])
        warnings.warn(f"no file matches {some}" + f" and {len(missing) - 10} more" * (len(missing) > 10), stacklevel=2)
    if distinct:
        found = found.groupBy("path").agg(F.min("nth").alias("nth"))
    order = Window.partitionBy("nth").orderBy("path")  # a pattern's own files
    ranked = found.withColumn("pos", (F.col("nth").cast("long") * F.lit(1 << 40) + F.row_number().over(order)))
    return ranked.select("path", "pos")


def with_extensions(files: DataFrame, extensions: list[str]) -> DataFrame:
    """Files whose ending is one of ``extensions``, with or without the dot, in any case."""
    wanted = ["." + e.lower().lstrip(".") for e in extensions]
    return files.where(F.lower(suffix("path")).isin(wanted))


def companions(files: DataFrame, there: DataFrame, ending: str = ".wav") -> DataFrame:
    """``files`` (path) with the companion of the same stem and whether ``there`` (path) has it."""
    want = files.withColumn("companion", with_suffix("path", ending))
    have = there.select(F.col("path").alias("companion"), F.lit(True).alias("found")).distinct()
    return want.join(have, "companion", "left").withColumn("found", F.coalesce("found", F.lit(False)))
