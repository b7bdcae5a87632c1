"""One file for each row, and renames: prepared by tasks under names of their own, then published, with a journal in between."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, stem, suffix

STAGED = ".quillwave-files-"  #: folder of a job's unpublished files, below the one they are for
JOURNAL = ".quillwave-renames-"  #: folder of a plan that is being carried out, below its root


def newline_name(path: Column | str) -> Column:
    """stem_newline.ext: the name of a text with carried-over line breaks."""
    return F.concat(stem(path), F.lit("_newline"), suffix(path))


def located(spark: SparkSession, folder: str) -> str:
    """``folder`` as a URI; one without a scheme is a local session's own disk, and an error on a cluster."""
    if ":/" in folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{folder!r} is each executor's own disk; name a folder that all share by its URI")
    return f"file://{folder.rstrip('/')}"


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with a scheme, as Spark writes it (blanks and all), and the place in it."""
    scheme, authority, path = re.fullmatch(r"([^:/]+):(?://([^/]*))?(.*)", uri, re.S).groups()
    store, place = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}{quote(path)}")
    return store, place.rstrip("/")


def _safe(name: str) -> str:
    if name.startswith("/") or ".." in name.split("/") or not name.strip("/"):
        raise ValueError(f"the name {name!r} leaves its folder")
    return name


def staged(rows: DataFrame, folder: str, token: str) -> DataFrame:
    """Each row's content written below a staging folder; returns the table (name, at, bytes) of what finished attempts wrote.

    Every attempt of a task has a folder of its own, and Spark's commit of the table
    decides which attempt's rows, and so which files, count.
    """
    base = f"{folder}/{STAGED}{token}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(base)
        attempt, i = uuid.uuid4().hex, 0
        store.create_dir(f"{root}/{attempt}", recursive=True)
        for batch in batches:
            places, sizes = [], []
            for name, data in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                _safe(name)
                held, i = data.as_py(), i + 1
                with store.open_output_stream(f"{root}/{attempt}/{i}") as out:
                    out.write(held)
                places.append(f"{attempt}/{i}")
                sizes.append(len(held))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(places, pa.string()), pa.array(sizes, pa.int64())], ["name", "at", "bytes"])

    rows.mapInArrow(run, "name string, at string, bytes long").write.parquet(f"{base}/manifest")
    return rows.sparkSession.read.schema("name string, at string, bytes long").parquet(f"{base}/manifest")


def publish(manifest: DataFrame, folder: str, token: str) -> None:
    """Moves staged files to their names; a file that has moved already is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        for batch in batches:
            for name, at in zip(batch.column("name").to_pylist(), batch.column("at").to_pylist(), strict=True):
                source = f"{root}/{STAGED}{token}/{at}"
                if store.get_file_info(source).type == fs.FileType.File:
                    store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                    store.move(source, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    manifest.select("name", "at").mapInArrow(run, "n long").agg(F.sum("n")).collect()


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> tuple[int, int]:
    """Writes each row's content (text or binary) under its name below ``folder``, a URI that all executors share; returns the number of files and bytes.

    Tasks write under names of their own; when all are done, a second job moves the files
    of those attempts that count to their names, and the rest goes.  If a task fails,
    nothing is published; a reader never sees part of a file.

    Existing files are replaced.  Names may hold folders, but a name that leaves ``folder``
    is an error, and so is one that two rows have.  Rows without a name or content write nothing.
    """
    spark, token = rows.sparkSession, uuid.uuid4().hex
    folder = located(spark, folder)
    wanted = rows.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content")).where("name is not null and content is not null")
    try:
        manifest = staged(wanted, folder, token)
        twice = manifest.groupBy("name").count().where("count > 1").head(1)
        if twice:
            raise ValueError(f"{twice[0]['count']} rows have the name {twice[0]['name']!r}")
        publish(manifest, folder, token)
        done = manifest.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        return done[0], done[1]
    finally:
        _removed(f"{folder}/{STAGED}{token}")


def _removed(uri: str) -> None:
    store, path = store_of(uri)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


def _by_task(rows: DataFrame, columns: list[str], root: str, act: Callable[[Callable[[str], bool], Callable[[str, str], None], tuple], str]) -> DataFrame:
    """(outcome): what ``act`` says of each row, given whether a name exists and how to move one, both below ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)

        def there(name: str) -> bool:
            return store.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound

        def move(a: str, b: str) -> None:
            store.move(f"{base}/{a}", f"{base}/{b}")

        for batch in batches:
            outcome = [act(there, move, row) for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(outcome, pa.string())], [*batch.schema.names, "outcome"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["outcome string"])
    return rows.mapInArrow(run, schema)


def journalled(plan: DataFrame, root: str, token: str) -> DataFrame:
    """The plan's renames as a written table (old, new, aside, outcome), full paths below ``root``; outcome is null for what can be done.

    A file whose new name is taken by one that this plan doesn't move away is refused as
    `exists`, and then so is one that was to get the refused one's name, and so on.
    """
    folder = F.when(F.col("folder") != "", F.concat("folder", F.lit("/"))).otherwise("")
    aside = F.concat(folder, F.lit(f".{token}."), F.sha1(F.col("new").cast("binary")))
    rows = plan.where("status = 'renamed'").select(F.concat(folder, "old").alias("old"), F.concat(folder, "new").alias("new"), aside.alias("aside"))
    leaving = rows.select(F.col("old").alias("new"), F.lit(True).alias("leaves"))
    seen = _by_task(rows, ["new"], root, lambda there, move, row: "there" if there(row[0]) else "free")
    state = seen.join(leaving, "new", "left").select("old", "new", "aside", F.when((F.col("outcome") == "there") & F.col("leaves").isNull(), "exists").alias("outcome"))
    n = 0
    while True:
        path = f"{root}/{JOURNAL}{token}/plan-{n}"
        state.write.parquet(path)
        state = rows.sparkSession.read.schema("old string, new string, aside string, outcome string").parquet(path)
        staying = state.where("outcome is not null").select(F.col("old").alias("new"), F.lit(True).alias("stays"))
        if not state.where("outcome is null").join(staying, "new").head(1):
            _mark(root, token, f"ready-{n}")
            return state
        state, n = state.join(staying, "new", "left").select("old", "new", "aside", F.when(F.col("stays"), "exists").otherwise(F.col("outcome")).alias("outcome")), n + 1


def _mark(root: str, token: str, phase: str) -> None:
    store, base = store_of(root)
    with store.open_output_stream(f"{base}/{JOURNAL}{token}/{phase}.mark") as out:
        out.write(b"")


def _marks(root: str) -> dict[str, set[str]]:
    """token -> the phases that are over, of every plan below ``root`` that was begun."""
    store, base = store_of(root)
    out: dict[str, set[str]] = {}
    for folder in store.get_file_info(fs.FileSelector(base, recursive=False)):
        if folder.base_name.startswith(JOURNAL):
            inside = store.get_file_info(fs.FileSelector(folder.path, recursive=False))
            out[folder.base_name.removeprefix(JOURNAL)] = {f.base_name.removesuffix(".mark") for f in inside if f.base_name.endswith(".mark")}
    return out


def _aside(there, move, row) -> str:
    old, aside = row
    if there(aside):
        return "aside"
    if not there(old):
        return "missing"
    move(old, aside)
    return "aside"


def _into(there, move, row) -> str:
    old, new, aside = row
    if not there(aside):
        return "renamed" if there(new) else "missing"
    if not there(new):
        move(aside, new)
        return "renamed"
    if not there(old):  # somebody made a file of the new name meanwhile
        move(aside, old)
        return "exists"
    return "kept aside"


def _taken_back(there, move, row) -> str:
    new, aside = row
    if not there(aside) and there(new):
        move(new, aside)
    return "aside"


def _restored(there, move, row) -> str:
    old, aside = row
    if not there(aside):
        return "restored" if there(old) else "missing"
    if there(old):
        return "kept aside"
    move(aside, old)
    return "restored"


def _carried_out(journal: DataFrame, root: str, token: str, marks: set[str]) -> dict[str, int]:
    """Both phases of a journal, or what is left of them."""
    todo = journal.where("outcome is null").select("old", "new", "aside")
    counts = lambda rows: {r["outcome"]: r["count"] for r in rows.groupBy("outcome").count().collect()}  # noqa: E731  a row an outcome
    if "aside" not in marks:
        counts(_by_task(todo, ["old", "aside"], root, _aside))
        _mark(root, token, "aside")
    out = counts(_by_task(todo, ["old", "new", "aside"], root, _into))
    refused = journal.where("outcome = 'exists'").count()
    if refused:
        out["exists"] = out.get("exists", 0) + refused
    if "kept aside" not in out:  # else the journal stays, as it knows where the files are
        _removed(f"{root}/{JOURNAL}{token}")
    return out


def apply_renames(plan: DataFrame, root: str) -> dict[str, int]:
    """Carries out a plan (folder, old, new, status) below ``root``; returns the number of rows by outcome.

    Names may be freed for one another, so files first move aside, to names of their own,
    and then to the new ones: two jobs whose tasks don't depend on each other.  Before, the plan
    is written to a journal below ``root``; if the driver is lost, :func:`resume_renames` ends what it
    began, or takes it back.  A task that runs again finds its file already moved and goes on.

    No file is replaced.  Outcomes: renamed; unchanged; missing (no such file any more);
    exists (its new name was taken since the plan was made; the file keeps its old one); kept aside
    (both names were taken while it was moved; the journal stays and tells its place).
    """
    spark, token = plan.sparkSession, uuid.uuid4().hex
    root = located(spark, root)
    out = _carried_out(journalled(plan, root, token), root, token, set())
    return out | {"unchanged": plan.where("status = 'unchanged'").count()}


def resume_renames(spark: SparkSession, root: str, back: bool = False) -> dict[str, int]:
    """Ends the renames below ``root`` that a lost driver left unfinished, or with ``back`` takes them back; the number of rows by outcome.

    A plan whose journal wasn't complete had moved nothing, and is forgotten.
    """
    root, total = located(spark, root), {}
    for token, marks in _marks(root).items():
        ready = [m for m in marks if m.startswith("ready-")]
        if not ready:
            _removed(f"{root}/{JOURNAL}{token}")
            continue
        journal = spark.read.schema("old string, new string, aside string, outcome string").parquet(f"{root}/{JOURNAL}{token}/plan-{ready[0].partition('-')[2]}")
        if back:
            todo = journal.where("outcome is null").select("old", "new", "aside")
            if "aside" in marks and "back" not in marks:  # some may have their new names
                _by_task(todo, ["new", "aside"], root, _taken_back).agg(F.count("outcome")).collect()
                _mark(root, token, "back")
            out = {r["outcome"]: r["count"] for r in _by_task(todo, ["old", "aside"], root, _restored).groupBy("outcome").count().collect()}
            if "kept aside" not in out:
                _removed(f"{root}/{JOURNAL}{token}")
        elif "back" in marks:
            raise ValueError(f"the renames of {token} are being taken back; resume them with back=True")
        else:
            out = _carried_out(journal, root, token, marks)
        for k, n in out.items():
            total[k] = total.get(k, 0) + n
    return total


def named_clips(clips: DataFrame, names: DataFrame) -> DataFrame:
    """(name, content) of clips (file, idx, content) under the names (file, idx, name) of an export."""
    return clips.join(names.select("file", "idx", "name"), ["file", "idx"]).select(basename("name").alias("name"), "content")
