"""Queries over files, clips, edges and transcripts, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths, text, times
from ..operators import manifest, naming, newlines, silence, transcribe
from ..sinks import files as file_sinks
from ..sources import audio, listing
from . import inputs
from .catalogue import _MANIFEST, ORACLE_SQL, QUERIES, _referred, query

_EDGES = """
    f AS (SELECT 'user' || user_id AS file, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS c, floor(value) AS level FROM events),
    edges AS (SELECT file, coalesce(a, n) * 10 AS lead, coalesce(n - 1 - b, n) * 10 AS tail
              FROM (SELECT file, min(c) FILTER (level >= 60) AS a, max(c) FILTER (level >= 60) AS b, max(c) + 1 AS n FROM f GROUP BY file)),
    aimed AS (SELECT *, greatest(0, round_even(30 + (2 * (CAST('0x' || substr(md5(file || '/lead'), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE) - 1) * 20, 0)) AS t_lead,
                     greatest(0, round_even(30 + (2 * (CAST('0x' || substr(md5(file || '/tail'), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE) - 1) * 20, 0)) AS t_tail FROM edges)"""
_TABLES = "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier".split()
_FIRST = [t for t in _TABLES if t[0] in "no"]


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = inputs.frames(spark, sf_dir).select("file", F.col("ms").alias("chunk"), F.col("ss").alias("level"))
    return silence.edge_silence(chunks, F.lit(60.0))


@query(
    f"""WITH {_EDGES} SELECT file, CAST(greatest(0, t_lead - lead) AS BIGINT) AS pad_lead, CAST(greatest(0, t_tail - tail) AS BIGINT) AS pad_tail,
    CAST(greatest(0, lead - t_lead) AS BIGINT) AS cut_lead, CAST(greatest(0, tail - t_tail) AS BIGINT) AS cut_tail FROM aimed"""
)
def edge_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What padding and what removing would do at each end, with jittered targets drawn apart."""
    edges = _edges(spark, sf_dir)
    padded = silence.adjust_edges(edges, "pad", target=30, jitter=20).select("file", "pad_lead", "pad_tail")
    return padded.join(silence.adjust_edges(edges, "remove", target=30, jitter=20).select("file", "cut_lead", "cut_tail"), "file")


@query(
    """SELECT 'user' || user_id AS file, round(20 * log10(sqrt(sum(floor(value)) / count(*)) / 32768) - 16, 6) AS threshold FROM events GROUP BY user_id"""
)
def auto_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silence.auto_threshold(inputs.frames(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


@query(f"SELECT name, place FROM (VALUES {', '.join(f"('{t}.parquet', {i})" for i, t in enumerate([*_FIRST, 'no such file', *[t for t in _TABLES if t not in _FIRST]], 1))}) t(name, place)")
def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder's own tables by three patterns in turn, each one path, be it a file or a folder of parts, at its first place; the pattern that names no file as it is."""
    found = listing.expand(spark, [f"{sf_dir}/[no]*.parquet", "no such file.parquet", f"{sf_dir}/**/*.parquet"], literal=True, as_files=(".parquet",))
    place = F.row_number().over(inputs.Window.orderBy("pos"))  # a handful of tables, however many parts they have
    return found.select(paths.basename("path").alias("name"), place.alias("place"))


@query(
    """WITH n AS (SELECT DISTINCT regexp_replace(url, '^https?://', '/') || '.html' AS path FROM pages)
    SELECT path, CASE WHEN regexp_matches(path, '^/[^/]*[02468][.][^/]*/(?:[^/]+/)*[^/]*[.]html$') THEN 0 WHEN regexp_matches(path, '^/[^/]*/[^/]*[.]html$') THEN 1 ELSE 2 END AS nth FROM n
    WHERE regexp_matches(path, '^/[^/]*[02468][.][^/]*/(?:[^/]+/)*[^/]*[.]html$|^/[^/]*/[^/]*[.]html$|^/(?:[^/]+/)*[^/]*[a-m][.]html$')"""
)
def matched_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of pages' addresses, matched with three globs in one pass; each path with the first that names it."""
    urls = inputs.table(spark, sf_dir, "pages").select(F.concat(F.regexp_replace("url", "^https?://", "/"), F.lit(".html")).alias("path"))
    return listing.matched(urls, ["/*[02468].*/**/*.html", "/*/*.html", "/**/*[a-m].html"])


@query(
    """WITH n AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages)
    SELECT page_id, path, CASE WHEN page_id % 3 = 0 THEN '.html' ELSE '.HTM' END AS ending FROM n WHERE page_id % 3 < 2 AND NOT suffix(path, '/')"""
)
def files_by_ending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the wanted endings, in any case, from a listing of several kinds put together; a name that is nothing but an ending has none."""
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("base"))
    kinds = [pages.where(F.col("page_id") % 3 == i).withColumn("path", F.concat("base", F.lit(e))) for i, e in enumerate((".html", ".HTM", ".txt"))]
    files = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    kept = listing.with_extensions(files, ["html", ".HTM"])
    return kept.select("page_id", F.col("base").alias("path"), paths.suffix("path").alias("ending"))


@query(
    """SELECT page_id, '/data/set/' || regexp_replace(url, '^https?://', '') AS below, url AS kept,
    regexp_replace(url, '^https?://', '') AS back FROM pages"""
)
def dataset_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths made absolute below a root and relative again; those with a scheme are whole already."""
    p = inputs.table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_replace("url", "^https?://", "").alias("bare"))
    below = paths.absolute("bare", "/data/set")
    return p.select("page_id", below.alias("below"), paths.absolute("url", "/data/set").alias("kept"), paths.relative(below, "/data/set/").alias("back"))


@query(
    """WITH s AS (SELECT event_id, CAST(round_even(value * 1000, 0) AS BIGINT) AS ms FROM events)
    SELECT event_id, format('{:02d}:{:02d}:{:02d},{:03d}', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock FROM s"""
)
def seconds_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds as floats written as times."""
    return inputs.table(spark, sf_dir, "events").select("event_id", times.clock_of_seconds("value").alias("clock"))


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
    e AS (SELECT doc_id, line_no, line || CASE length(line) % 5 WHEN 0 THEN ' ' WHEN 1 THEN '(' WHEN 2 THEN '—' WHEN 3 THEN chr(12288) ELSE '' END AS line FROM l)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line = '' OR regexp_matches(right(line, 1), '[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}(“—]') AS may_break FROM e"""
)
def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a break may follow each line of each text, with the marks that decide it put behind some."""
    lines = inputs.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    end = F.element_at(F.array(*[F.lit(x) for x in (" ", "(", "—", "　", "")]), F.length("line") % 5 + 1)
    return lines.select("doc_id", "line_no", text.breaks(F.concat("line", end)).alias("may_break"))


@query("SELECT 'conv' || conv_id AS file, rtrim(string_agg(text, ' ' ORDER BY turn), ' ') AS text FROM conversations GROUP BY conv_id")
def joined_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = inputs.table(spark, sf_dir, "conversations").select(F.concat(F.lit("conv"), "conv_id").alias("file"), F.col("turn").alias("idx"), "text")
    return transcribe.joined_text(parts)


@query("SELECT 'conv' || conv_id AS file, turn AS idx, role, octet_length(encode(text)) || ' bytes' AS text FROM conversations")
def transcribed_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips recognised by the stub, and met with their rows by key."""
    rows = inputs.table(spark, sf_dir, "conversations").select(F.concat(F.lit("conv"), "conv_id").alias("file"), F.col("turn").alias("idx"), "role", F.col("text").cast("binary").alias("content"))
    heard = transcribe.transcribe(rows, "none").where("error is null").select("file", "idx", "text")
    return rows.select("file", "idx", "role").join(heard, ["file", "idx"])


def _wavs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, content): each user's values as the samples of a recording, five a ms."""
    order = F.array_sort(F.collect_list(F.struct("ms", F.col("ss").cast("long").alias("v"))))  # a recording's own
    two = lambda x: F.format_string("%02X%02X", x.bitwiseAND(F.lit(255)), F.shiftright(x, 8))
    four = lambda n: F.format_string("%02X%02X%02X%02X", *[F.shiftright(n, 8 * i).bitwiseAND(F.lit(255)) for i in range(4)])
    rows = inputs.frames(spark, sf_dir).groupBy("file").agg(F.array_join(F.transform(order, lambda x: two(x["v"])), "").alias("data"))
    size = (F.length("data") / 2).cast("long")
    # The head of a WAV file of one channel, 5000 samples a second, 16 bits.
    head = F.concat(F.lit("52494646"), four(size + 36), F.lit("57415645666D7420100000000100010088130000102700000200100064617461"), four(size))
    return rows.select("file", F.unhex(F.concat(head, "data")).alias("content"))


@query("SELECT 'user' || user_id AS file, string_agg(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ' ' ORDER BY ts, event_id) AS text FROM events GROUP BY user_id")
def transcribed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings heard in windows that overlap and stitched again: what hearing them whole gives."""
    wavs = _wavs(spark, sf_dir)
    totals = wavs.select("file", F.ceil((F.length("content") - 44) / 10).alias("total"))
    clips = audio.cut_clips(wavs, transcribe.windows(totals, window=8, overlap=2))
    return transcribe.stitched(transcribe.transcribe(clips, "none", "levels").where("error is null"), window=8, overlap=2)


@query(
    """WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ms, CAST(floor(value) AS BIGINT) AS v FROM events)
    SELECT 'user' || user_id AS file, CAST(1 AS BIGINT) AS idx, repeat('000000', 10) || string_agg(printf('00%02X%02X', v & 255, v >> 8), '' ORDER BY ms) FILTER (ms >= 10 AND ms < 30) || repeat('000000', 15) AS samples
    FROM f GROUP BY user_id"""
)
def clip_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stretch of each recording cut out, padded at both ends and widened from 16 to 24 bits; its samples in hexadecimal."""
    wavs = _wavs(spark, sf_dir)
    spans = wavs.selectExpr("file", "1L idx", "2L start", "6L end", "2L pad_lead", "3L pad_tail")
    return audio.cut_clips(wavs, spans, bits=24).select("file", "idx", F.hex(F.expr("substring(content, 45)")).alias("samples"))


@query(
    f"""WITH {_MANIFEST} SELECT line_no, audio, row_number() OVER (ORDER BY md5('3/order/' || line_no), line_no) AS place FROM referred"""
)
def manifest_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in a shuffled manifest."""
    return manifest.places(_referred(spark, sf_dir), seed=3).select("line_no", "audio", "place")


@query(f"SELECT CASE WHEN target = old THEN 'unchanged' ELSE 'renamed' END AS status, count(*) AS n FROM ({ORACLE_SQL['clean_names']}) GROUP BY 1")
def rename_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.rename_counts(QUERIES["rename_plan"](spark, sf_dir))


@query(
    """SELECT conv_id, turn, 'conv' || conv_id || '.' || turn || '_newline.txt' AS name,
    'Preface' || chr(10) || '&word extra ' || replace(text, chr(10), ' ' || chr(10)) || ' ending' AS text FROM conversations"""
)
def newline_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaks of transcripts that differ from their originals: words are missing there, and one is broken, which is marked."""
    rows = inputs.table(spark, sf_dir, "conversations")
    original = F.concat(F.lit("Prefaceword extra "), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(" ending"))
    path = F.concat(F.lit("texts/conv"), "conv_id", F.lit("."), "turn", F.lit(".txt"))
    pairs = rows.select("conv_id", "turn", file_sinks.newline_name(path).alias("name"), original.alias("original"), F.concat(F.lit("Preface\nword "), "text").alias("transcribed"))
    return newlines.carry_breaks(pairs, mark=True).select("conv_id", "turn", "name", "text")


@query(
    """WITH t AS (SELECT conv_id, turn, regexp_replace(replace(text, chr(10), ' '), '^[^ ]+', 'turn' || turn) AS line FROM conversations WHERE turn IS NOT NULL AND text IS NOT NULL)
    SELECT conv_id, string_agg(line, ' ' || chr(10) ORDER BY turn, line) AS text FROM t GROUP BY conv_id"""
)
def newline_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations broken as their transcripts are, turn by turn, where a transcript has a word more or less in two of three turns; compared in pieces."""
    told = inputs.table(spark, sf_dir, "conversations").where("turn is not null and text is not null")
    line = F.regexp_replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("^[^ ]+"), F.concat(F.lit("turn"), "turn"))
    kind = F.length(line) % 3
    heard = F.when(kind == 1, F.regexp_replace(line, "^([^ ]+ [^ ]+ )", "$1zq ")).when(kind == 2, F.regexp_replace(line, "^([^ ]+ [^ ]+ )[^ ]+ ", "$1")).otherwise(line)
    turns = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"), heard.alias("heard"))))  # a conversation's own
    pairs = told.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.array_join("turns.line", " ").alias("original"), F.array_join("turns.heard", "\n").alias("transcribed")
    )
    return newlines.carry_breaks(pairs, spread=True, words=60).select("conv_id", "text")
