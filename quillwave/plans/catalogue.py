"""Queries over the test tables, one for each operator or family, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths, text, times
from ..operators import cues, manifest, naming, newlines, silence
from ..sinks import texts
from ..sources import listing, subtitles
from . import inputs

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
MIN_MS, MAX_MS, KEEP_MS = 3 * 3_600_000, 48 * 3_600_000, 3_600_000

_CUES = """
    shown AS (SELECT conv_id, turn, length(text) * 60 AS d, CASE WHEN turn % 3 = 1 THEN ' (note) ' || text ELSE text END AS text FROM conversations),
    cues AS (SELECT 'conv ' || conv_id AS file, turn AS cue_no, CAST(sum(d + 400) OVER w - 400 - d AS BIGINT) AS start, CAST(sum(d + 400) OVER w - 400 AS BIGINT) AS "end", text
             FROM shown WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
    timed AS (SELECT *, max("end") OVER (PARTITION BY file) + 1000 AS audio_ms FROM cues),
    placed AS (SELECT file, cue_no, text, coalesce((lag("end") OVER w + start) // 2, start) AS a, ("end" + coalesce(lead(start) OVER w, audio_ms)) // 2 AS b,
                      lag(cue_no) OVER w IS NULL OR lead(cue_no) OVER w IS NULL AS outer_cue FROM timed WINDOW w AS (PARTITION BY file ORDER BY cue_no)),
    clips AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY cue_no) AS clip, a AS start, b AS "end", text FROM placed
              WHERE outer_cue OR NOT regexp_matches(text, '^\\s*[*(]'))"""
_RECORDINGS = """
    timed AS (SELECT 'user' || user_id AS file, epoch_us(ts) // 1000 - min(epoch_us(ts) // 1000) OVER (PARTITION BY user_id) AS t FROM events),
    files AS (SELECT file, max(t) + 1 AS total FROM timed GROUP BY file),
    sil AS (SELECT file, s, e FROM (SELECT file, t AS s, lead(t) OVER (PARTITION BY file ORDER BY t) AS e FROM timed) WHERE e - s >= 7200000),
    lists AS (SELECT f.file, f.total, coalesce(l, []) AS l FROM files f LEFT JOIN (SELECT file, list({'k': s - e, 's': s, 'm': (s + e) // 2, 'e': e} ORDER BY s - e, s) AS l FROM sil GROUP BY file) x ON f.file = x.file)"""
_PARTS = f"""
    parts(file, a, b, m, l) AS (
        SELECT file, CAST(0 AS BIGINT), total, CASE WHEN total > {MAX_MS} THEN list_filter(l, lambda x: x.m >= {MIN_MS} AND total - x.m >= {MIN_MS} AND x.e <= total)[1].m END, l FROM lists
        UNION ALL
        SELECT file, a2, b2, CASE WHEN b2 - a2 > {MAX_MS} THEN list_filter(l, lambda x: x.s >= a2 AND x.e <= b2 AND x.m - a2 >= {MIN_MS} AND b2 - x.m >= {MIN_MS})[1].m END, l
        FROM (SELECT file, CASE WHEN half = 0 THEN a ELSE m END AS a2, CASE WHEN half = 0 THEN m ELSE b END AS b2, l FROM parts, (VALUES (0), (1)) h(half) WHERE m IS NOT NULL)
    ),
    segments AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY a) AS idx, a AS raw_start, b AS raw_end FROM parts WHERE m IS NULL)"""
_TRIMMED = f"""
    met AS (SELECT g.file, idx, raw_start, raw_end, min(CASE WHEN s <= raw_start AND raw_start < e AND e <= raw_end THEN e END) AS lead,
                   max(CASE WHEN s < raw_end AND raw_end <= e AND s >= raw_start THEN s END) AS tail
            FROM segments g LEFT JOIN sil ON g.file = sil.file GROUP BY ALL),
    trimmed AS (SELECT *, greatest(export_start, least(CASE WHEN raw_end - tail > {KEEP_MS} THEN tail + {KEEP_MS} ELSE raw_end END, total)) AS export_end
                FROM (SELECT m.*, total, greatest(0, CASE WHEN lead - raw_start > {KEEP_MS} THEN lead - {KEEP_MS} ELSE raw_start END) AS export_start FROM met m JOIN files f ON m.file = f.file))"""
_CLOCK = "format('{{:02d}}:{{:02d}}:{{:02d}}{p}{{:03d}}', {c} // 3600000, {c} // 60000 % 60, {c} // 1000 % 60, {c} % 1000)"
_SPACE = "[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def _strip_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


_MANIFEST = f"""
    doc AS (SELECT doc_id, 'src' || doc_id % 7 || '/clip' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '.wav' ELSE '' END AS name,
                   regexp_replace(text, '[\\n\\r|]', ' ', 'g') AS t FROM documents),
    lines AS (SELECT doc_id AS line_no, CASE doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN name WHEN 2 THEN name || '|' || t || '|' || replace(t, 'e', 'E') WHEN 3 THEN name || '|' || t || '|'
                     WHEN 4 THEN name || '|' || t || '|' || t || '|more' ELSE name || '| ' || t || chr(12288) END AS value FROM doc),
    fields AS (SELECT line_no, value, string_split(value, '|') AS f FROM lines),
    parsed AS (SELECT line_no, {_strip_sql("f[1]")} AS name, {_strip_sql("f[2]")} AS text,
                      CASE WHEN len(f) >= 3 THEN {_strip_sql("f[3]")} ELSE {_strip_sql("f[2]")} END AS normalized,
                      CASE WHEN value = '' THEN 'empty' WHEN len(f) < 2 THEN 'malformed' ELSE 'ok' END AS status FROM fields),
    there AS (SELECT 'wavs/src' || doc_id % 7 || '/clip' || doc_id || '.wav' AS path FROM documents WHERE doc_id % 10 <> 9),
    resolved AS (SELECT p.line_no, p.name, p.text, p.normalized, coalesce(a.path, b.path) AS audio,
                        CASE WHEN p.status = 'ok' AND a.path IS NULL AND b.path IS NULL THEN 'missing' ELSE p.status END AS status
                 FROM parsed p LEFT JOIN there a ON p.status = 'ok' AND p.name <> '' AND a.path = 'wavs/' || p.name || '.wav'
                      LEFT JOIN there b ON p.status = 'ok' AND p.name <> '' AND b.path = 'wavs/' || p.name),
    based AS (SELECT *, regexp_extract(audio, '^(.*)/[^/]*$', 1) AS dir FROM resolved WHERE status = 'ok'),
    counted AS (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY line_no) - 1 AS pos, count(*) OVER (PARTITION BY dir) AS size,
                       row_number() OVER (PARTITION BY dir ORDER BY md5('7/pick/' || line_no), line_no) AS turn,
                       CAST(('0x' || substr(md5('7/partner/' || line_no), 1, 12)) AS BIGINT) AS h FROM based),
    wanted AS (SELECT *, CASE WHEN turn <= least(size, round_even(size * 0.4, 0)) THEN CASE WHEN size = 1 THEN h % size ELSE (pos + 1 + h % greatest(size - 1, 1)) % size END END AS want FROM counted),
    referred AS (SELECT w.line_no, w.audio, w.text, w.normalized, w.dir, w.pos, o.audio AS ref_audio FROM wanted w LEFT JOIN counted o ON w.dir = o.dir AND w.want = o.pos)"""


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.clips(inputs.cue_audio(inputs.cues(spark, sf_dir)), "audio_ms")


@query(f'WITH {_CUES} SELECT file, clip, start, "end", text FROM clips')
def cue_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Midpoint clips, remarks left out, numbered again."""
    return _clips(spark, sf_dir)


@query(f"WITH {_CUES} SELECT file, clip, file || '/' || replace(file, ' ', '_') || '_' || clip || '.wav|' || text AS line FROM clips")
def clip_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.metadata_lines(_clips(spark, sf_dir), keep_folder=True)


@query(f'WITH {_CUES}, t AS (SELECT count(*) AS clips, CAST(sum("end" - start) AS BIGINT) AS total_ms FROM clips) SELECT clips, total_ms, {_CLOCK.format(p=",", c="total_ms")} AS total FROM t')
def clip_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.total_ms(_clips(spark, sf_dir)).withColumn("total", times.clock("total_ms"))


@query(
    f"""WITH t AS (SELECT event_id, event_id * 7919 * 37 AS ms FROM events)
    SELECT event_id, {_CLOCK.format(p=",", c="ms")} AS comma, {_CLOCK.format(p=".", c="ms")} AS point, ms AS back, CAST(floor(ms / 1000.0) AS BIGINT) * 1000 + (event_id % 100) * 10 AS ass FROM t"""
)
def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written both ways, and read back from both kinds of subtitles."""
    t = inputs.table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 7919 * 37).alias("ms"))
    whole = times.clock(F.floor(F.col("ms") / 1000) * 1000, ".")
    ass = F.concat(F.substring_index(whole, ".", 1), F.lit("."), F.lpad((F.col("event_id") % 100).cast("string"), 2, "0"))
    return t.select("event_id", times.clock("ms").alias("comma"), times.clock("ms", ".").alias("point"), times.srt_ms(times.clock("ms")).alias("back"), times.ass_ms(ass).alias("ass"))


@query(
    f"""WITH d AS (SELECT doc_id, text AS t FROM documents), c AS (SELECT doc_id, t,
    regexp_replace(regexp_replace(regexp_replace(t, '({_SPACE}|[''"‘’“”「」『』])+', '_', 'g'), '^_+', ''), '_+$', '') AS n FROM d)
    SELECT doc_id, CASE WHEN n = '' THEN '_' ELSE n END AS clean, {_strip_sql("t")} AS stripped,
    replace(replace(replace(replace(replace(replace('(' || chr(10) || t || chr(10) || ')', '(' || chr(10), chr(10) || '('), '“' || chr(10), chr(10) || '“'), '‘' || chr(10), chr(10) || '‘'),
    chr(10) || ')', ')' || chr(10)), chr(10) || '”', '”' || chr(10)), chr(10) || '’', '’' || chr(10)) AS tidy FROM c"""
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    framed = F.concat(F.lit("(\n"), "t", F.lit("\n)"))
    return d.select("doc_id", text.clean_name("t").alias("clean"), text.strip("t").alias("stripped"), text.tidy_breaks(framed).alias("tidy"))


@query(
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '([^/]*)/*$', 1) AS name FROM pages)
    SELECT page_id, name, regexp_extract(url, '^(.*)/[^/]*$', 1) AS parent,
    CASE WHEN regexp_matches(name, '^(.+)(\\.[^.]+)$') THEN regexp_extract(name, '^(.+)(\\.[^.]+)$', 1) ELSE name END AS stem, regexp_extract(name, '^(.+)(\\.[^.]+)$', 2) AS suffix FROM p"""
)
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.table(spark, sf_dir, "pages")
    return p.select("page_id", paths.basename("url").alias("name"), paths.parent("url").alias("parent"), paths.stem("url").alias("stem"), paths.suffix("url").alias("suffix"))


@query(
    """WITH f AS (SELECT 'user' || user_id AS file, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ms, floor(value) AS ss FROM events),
    w AS (SELECT file, ms, sum(ss) OVER x AS total, count(*) OVER x AS n FROM f WINDOW x AS (PARTITION BY file ORDER BY ms ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
    q AS (SELECT file, ms, CASE WHEN ms - lag(ms) OVER (PARTITION BY file ORDER BY ms) <= 3 THEN 0 ELSE 1 END AS new FROM w WHERE n = 3 AND total <= 40 * 3),
    i AS (SELECT file, ms, sum(new) OVER (PARTITION BY file ORDER BY ms) AS island FROM q)
    SELECT file, min(ms) AS s, max(ms) + 3 AS e FROM i GROUP BY file, island"""
)
def silence_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silence.silences(inputs.frames(spark, sf_dir), F.lit(40.0), min_len=3)


@query(
    """WITH f AS (SELECT 'user' || user_id AS file, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS c, floor(value) AS level FROM events),
    g AS (SELECT file, min(c) FILTER (level >= 60) AS a, max(c) FILTER (level >= 60) AS b, max(c) + 1 AS n FROM f GROUP BY file)
    SELECT file, coalesce(a, n) * 10 AS lead, coalesce(n - 1 - b, n) * 10 AS tail, n * 10 AS length FROM g"""
)
def edge_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = inputs.frames(spark, sf_dir).select("file", F.col("ms").alias("chunk"), F.col("ss").alias("level"))
    return silence.edge_silence(chunks, F.lit(60.0))


def _segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    files, gaps = inputs.recordings(spark, sf_dir)
    return silence.split(files, gaps, MIN_MS, MAX_MS), gaps, files


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silence.trim(*_segments(spark, sf_dir), KEEP_MS)


@query(f"WITH RECURSIVE {_RECORDINGS}, {_PARTS} SELECT file, idx, raw_start, raw_end FROM segments")
def silence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oracle recurses; the query decides silences in blocks of time."""
    return _segments(spark, sf_dir)[0]


@query(f"WITH RECURSIVE {_RECORDINGS}, {_PARTS}, {_TRIMMED} SELECT file, idx, raw_start, raw_end, export_start, export_end FROM trimmed")
def silence_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir)


@query(
    f"""WITH RECURSIVE {_RECORDINGS}, {_PARTS}, {_TRIMMED} SELECT file, string_agg(idx || chr(10) || {_CLOCK.format(p=",", c="export_start")} || ' --> ' || {_CLOCK.format(p=",", c="export_end")}
    || chr(10) || '[Segment ' || idx || ']' || chr(10), chr(10) ORDER BY idx) AS content FROM trimmed GROUP BY file"""
)
def srt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.srt_files(_trimmed(spark, sf_dir).withColumn("text", F.lit("")))


@query(
    f"""WITH RECURSIVE {_RECORDINGS}, {_PARTS}, {_TRIMMED}, c AS (SELECT *, count(*) OVER (PARTITION BY file) AS k FROM trimmed)
    SELECT file, idx, {_CLOCK.format(p=".", c="export_start")} AS start, {_CLOCK.format(p=".", c="export_end")} AS "end", (export_end - export_start) / 1000.0 AS seconds,
    file || '_' || lpad(CAST(idx AS VARCHAR), greatest(3, length(CAST(k AS VARCHAR)))::INT, '0') || '.wav' AS name FROM c"""
)
def preview_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview table with the names that an export would use."""
    rows = _trimmed(spark, sf_dir)
    return texts.preview(rows).join(texts.clip_names(rows).select("file", "idx", "name"), ["file", "idx"])


def _resolved(spark: SparkSession, sf_dir: str, one_folder: bool = False) -> DataFrame:
    return manifest.resolve(manifest.parse(inputs.manifest_lines(spark, sf_dir, one_folder)), inputs.audio_files(spark, sf_dir, one_folder))


def _referred(spark: SparkSession, sf_dir: str, one_folder: bool = False) -> DataFrame:
    return manifest.references(_resolved(spark, sf_dir, one_folder).where("status = 'ok'").drop("status", "name"), ratio=0.4, seed=7)


@query(f"WITH {_MANIFEST} SELECT line_no, name, text, normalized, status, audio FROM resolved")
def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)


@query(f"WITH {_MANIFEST} SELECT status, count(*) AS n FROM resolved GROUP BY status")
def manifest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(_resolved(spark, sf_dir))


@query(f"WITH {_MANIFEST} SELECT line_no, audio, text, normalized, dir, pos, ref_audio FROM referred")
def manifest_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _referred(spark, sf_dir)


_ONE_FOLDER = _MANIFEST.replace("'src' || doc_id % 7 || '/clip'", "'clip'").replace("'wavs/src' || doc_id % 7 || '/clip'", "'wavs/clip'")


@query(f"WITH {_ONE_FOLDER} SELECT line_no, audio, dir, pos, ref_audio FROM referred")
def manifest_one_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References where all clips lie in one folder."""
    return _referred(spark, sf_dir, one_folder=True).select("line_no", "audio", "dir", "pos", "ref_audio")


_TWO = _MANIFEST
for _purpose in ("pick", "partner"):
    _TWO = _TWO.replace(f"'7/{_purpose}/' || line_no", f"'7/{_purpose}/m' || line_no % 2 || '/' || line_no // 2")
_TWO = _TWO.replace("PARTITION BY dir ORDER BY line_no", "PARTITION BY dir ORDER BY line_no % 2, line_no // 2").replace("line_no // 2), line_no)", "line_no // 2), line_no % 2, line_no // 2)")


@query(f"WITH {_TWO} SELECT 'm' || line_no % 2 AS manifest, line_no // 2 AS line_no, audio, dir, pos, ref_audio FROM referred")
def two_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References across two manifests whose lines have the same numbers and whose clips share folders."""
    rows = _resolved(spark, sf_dir).where("status = 'ok'")
    rows = rows.select(F.concat(F.lit("m"), (F.col("line_no") % 2).cast("string")).alias("manifest"), F.floor(F.col("line_no") / 2).alias("line_no"), "audio")
    return manifest.references(rows, ratio=0.4, seed=7, key=("manifest", "line_no")).select("manifest", "line_no", "audio", "dir", "pos", "ref_audio")


@query(
    f"""WITH {_MANIFEST} SELECT count(*) AS total, count(DISTINCT dir) AS folders, count(ref_audio) AS refs, CASE WHEN count(*) > 0 THEN 100.0::DOUBLE * count(ref_audio) / count(*) ELSE 0 END AS actual_pct,
    40.0::DOUBLE AS target_pct FROM referred"""
)
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.summary(_referred(spark, sf_dir), 0.4)


@query(
    f"""WITH {_MANIFEST} SELECT line_no, '{{"audio": ' || to_json(audio) || ', "text": ' || to_json(normalized) || CASE WHEN ref_audio IS NOT NULL THEN ', "ref_audio": ' || to_json(ref_audio) ELSE '' END || '}}' AS line,
    row_number() OVER (ORDER BY dir, line_no) AS place FROM referred"""
)
def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with their place in the order by folder, counted from running totals of the folders."""
    rows = _referred(spark, sf_dir)
    from pyspark.sql import Window

    before = Window.orderBy("dir").rowsBetween(Window.unboundedPreceding, -1)  # one row a folder
    sizes = rows.groupBy("dir").agg(F.count("*").alias("k")).select("dir", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    return rows.join(sizes, "dir").select("line_no", manifest.json_lines(rows).alias("line"), (F.col("base") + F.col("pos") + 1).alias("place"))


@query(
    f"""WITH n AS (SELECT doc_id, source AS folder, replace(split_part(text, chr(10), 1), '/', ' ') || '.txt' AS old FROM documents),
    s AS (SELECT *, CASE WHEN regexp_matches(old, '^(?s:(.+))(\\.[^.]+)$') THEN regexp_extract(old, '^((?s:.)+)(\\.[^.]+)$', 1) ELSE old END AS st, regexp_extract(old, '^((?s:.)+)(\\.[^.]+)$', 2) AS sx FROM n),
    c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(st, '({_SPACE}|[''"‘’“”「」『』])+', '_', 'g'), '^_+', ''), '_+$', '') AS k FROM s)
    SELECT DISTINCT folder || '/' || old AS path, folder, old, CASE WHEN k = '' THEN '_' ELSE k END || sx AS target FROM c"""
)
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.cleaned(inputs.names(spark, sf_dir)).distinct()


@query()
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in a folder depend on each other in order, which SQL doesn't express; tested against a sequential rename."""
    names = inputs.names(spark, sf_dir)
    return naming.rename_plan(names, names.select("path").distinct())


@query(
    """SELECT doc_id AS id, 'src' || doc_id % 5 || '/f' || doc_id || '.srt' AS path, 'src' || doc_id % 5 || '/f' || doc_id || '.wav' AS companion, doc_id % 3 <> 0 AS found FROM documents"""
)
def companion_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("src"), (F.col("doc_id") % 5).cast("string"), F.lit("/f"), F.col("doc_id").cast("string")).alias("p"))
    files = d.select("id", F.concat("p", F.lit(".srt")).alias("path"))
    there = d.where("id % 3 <> 0").select(F.concat("p", F.lit(".wav")).alias("path"))
    return listing.companions(files, there).select("id", "path", "companion", "found")


@query(f'WITH {_CUES} SELECT file, row_number() OVER (PARTITION BY file ORDER BY cue_no) AS cue_no, start, "end", trim(regexp_replace(text, \'\\s+\', \' \', \'g\')) AS text FROM cues')
def srt_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues written as a subtitle file and read back."""
    rows = inputs.cues(spark, sf_dir).withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    named = rows.select("file", F.col("cue_no").alias("idx"), F.col("start").alias("export_start"), F.col("end").alias("export_end"), "text")
    return subtitles.srt_cues(texts.srt_files(named).withColumnRenamed("content", "value"))


@query(
    f"""WITH {_CUES} SELECT file, row_number() OVER (PARTITION BY file ORDER BY start // 10, cue_no) AS cue_no, start // 10 * 10 AS start, "end" // 10 * 10 AS "end", trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM cues"""
)
def ass_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues written as a styled subtitle file, lines in reverse, and read back."""
    rows = inputs.cues(spark, sf_dir)
    stamp = lambda c: F.expr(f"substring(format_string('%02d:%02d:%02d.%02d', {c} div 3600000, {c} div 60000 % 60, {c} div 1000 % 60, {c} div 10 % 100), 2)")
    line = F.concat(F.lit("Dialogue: 0,"), stamp("end"), F.lit(","), stamp("start"), F.lit(r",{\an8}"), F.trim(F.regexp_replace("text", r"\s+", " ")))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cue_no", line.alias("x"))), asc=False), lambda s: s["x"]), "\n")
    head = "[Script Info]\nTitle: x\n[Events]\nFormat: Layer, End, Start, Text\nComment: 0,0:00:00.00,0:00:01.00,no\n"
    return subtitles.ass_cues(rows.groupBy("file").agg(F.concat(F.lit(head), body, F.lit("\n[Fonts]\nDialogue: 0,0:00:00.00,0:00:01.00,no")).alias("value")))


@query("SELECT conv_id, turn, replace(text, chr(10), ' ') AS original, text FROM conversations")
def newline_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without their line breaks get them back from a transcript that has them: what the transfer must restore exactly."""
    rows = inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.replace("text", F.lit("\n"), F.lit(" ")).alias("original"), F.col("text").alias("transcribed"))
    back = newlines.carry_breaks(rows)
    # The break stands in for the blank it replaced, which stays before or behind it.
    return back.select("conv_id", "turn", "original", F.regexp_replace("text", " ?\n ?", "\n").alias("text"))
