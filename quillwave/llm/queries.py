"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversation_repair import conversation_repair, damaged
from .hash_forest import nearest
from .importance import importance_resample
from .language_id import language_id
from .line_templates import line_dedup
from .mixing import mix
from .ngram_join import ngram_join
from .packing import pack
from .sharding import shard_documents
from .stream_bpe import round_trip
from .substring_dedup import substring_dedup
from .topk_search import exact_top_k
from .vocabularies import vocabulary
from .warc_zip import archive_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op3_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return substring_dedup(docs, window=20, one_space=True).select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_md5"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), size=5, percent=80).select("doc_id", "n_shingles", "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair(conversations, damaged(conversations))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, longest=1, least_words=20, seed=2024)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), percent=150, weights=(3, 1, 2), most=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_warc": op2_warc,
    "op3_stream_bpe": op3_stream_bpe,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_nearest": op6_nearest,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_sharding": op8_sharding,
    "op9_line_templates": op9_line_templates,
    "op10_ngram_join": op10_ngram_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_source_mixing": op13_source_mixing,
}

# Checksums (CRC-32) of texts: a table of 256 entries by its rule, then a byte at a time.
_CRC = """
    crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END)) AS tab)"""


def _crc32(text: str) -> str:
    """SQL for the checksum of an expression's UTF-8 bytes, where crc_table is joined."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT))"


def _edit(v: str, cost: str, letter: str, left: str | None) -> str:
    """SQL for a state's value (cost, audit, repaired text) after an edit that leaves a turn, or none."""
    text = f"{v}.t" if left is None else f"CASE WHEN {v}.n > 0 THEN {v}.t || chr(10) ELSE '' END || {left}"
    return f"CASE WHEN {v} IS NOT NULL THEN {{'c': {v}.c + {cost}, 'a': {v}.a || '{letter}', 't': {text}, 'n': {v}.n + {0 if left is None else 1}}} END"


# The values of the four states (begin, after s, after u, after a) with turns inserted before the next one.
_INSERTED = f"""
    SELECT * REPLACE (least(w3, {_edit("w2", "3", "I", "'assistant:'")}) AS w3) FROM (
        SELECT * EXCLUDE (v0, v1, v2, v3), v0 AS w0, v1 AS w1, least(v2, {", ".join(_edit(v, "3", "I", "'user:'") for v in ("v0", "v1", "v3"))}) AS w2, v3 AS w3 FROM"""
_KEEP, _RENAME = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END", "CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END"


def _kept(v: str, role: str) -> str:
    return f"CASE WHEN alive AND role[1] = '{role}' THEN {_edit(v, _KEEP, 'K', "role || ':' || text")} END"


def _renamed(v: str, role: str) -> str:
    return f"CASE WHEN alive THEN {_edit(v, _RENAME, 'R', f"'{role}:' || text")} END"

ORACLE_SQL = {
    "op1_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_line_templates": """
        WITH lines AS (
            SELECT DISTINCT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line, ' ') <> ''
        ), leafed AS (
            SELECT doc_id, line, len(string_split(line, ' ')) AS n,
                   array_to_string(list_transform(string_split(line, ' ')[1:3], lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ') AS lead
            FROM lines
        ), held AS (
            SELECT l.* FROM leafed l JOIN (SELECT n, lead FROM leafed GROUP BY n, lead HAVING count(*) >= 10) c ON l.n = c.n AND l.lead = c.lead
        ), spread AS (
            SELECT n, lead, line, c, unnest(string_split(line, ' ')) AS raw, unnest(range(n)) AS pos
            FROM (SELECT n, lead, line, count(*) AS c FROM held GROUP BY ALL)
        ), tokens AS (
            SELECT n, lead, line, c, pos, CASE WHEN regexp_matches(raw, '[0-9]') THEN '<*>' ELSE raw END AS token FROM spread
        ), fixed AS (
            SELECT n, lead, pos, token, CAST(sum(c) AS BIGINT) // 10 AS s FROM tokens WHERE token <> '<*>' GROUP BY n, lead, pos, token HAVING sum(c) >= 10
        ), known AS (
            SELECT t.n, t.lead, t.line, t.pos, t.token, coalesce(length(bin(f.s)), 0) AS up
            FROM tokens t LEFT JOIN fixed f ON t.n = f.n AND t.lead = f.lead AND t.pos = f.pos AND t.token = f.token
        ), templates AS (
            SELECT k.n, k.lead, k.line, l.level, list(CASE WHEN k.up >= l.level THEN k.token ELSE '<*>' END ORDER BY k.pos) AS template, count(*) FILTER (k.up >= l.level) AS f
            FROM known k JOIN (SELECT DISTINCT line, up AS level FROM known WHERE up > 0) l ON k.line = l.line
            GROUP BY k.n, k.lead, k.line, l.level
        ), used AS (
            SELECT h.doc_id, h.line, h.n, h.lead, p.template FROM held h JOIN templates p ON h.line = p.line WHERE p.f >= 0.75 * p.n
        ), often AS (
            SELECT n, lead, template FROM used GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10
        ), gone AS (
            SELECT doc_id, list(DISTINCT line) AS gone FROM used u JOIN often o ON u.n = o.n AND u.lead = o.lead AND u.template = o.template GROUP BY doc_id
        ), cut AS (
            SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS lines,
                   CASE WHEN g.gone IS NULL THEN string_split(d.text, chr(10)) ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(g.gone, x)) END AS kept
            FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id
        )
        SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
               md5(coalesce(array_to_string(kept, chr(10)), '')) AS text_md5
        FROM cut
    """,
    "op2_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
        FROM p
    """,
    "op7_substring_dedup": """
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS w FROM documents
        ), windows AS (
            SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
        ), later AS (
            SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later
        ), placed AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
        ), kept AS (
            SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text, count(*) AS n
            FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
    "op10_ngram_join": """
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM d WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
        ), links AS (
            SELECT o.a, o.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) o
            JOIN sizes m ON o.a = m.doc_id JOIN sizes n ON o.b = n.doc_id WHERE 100 * o.c >= 80 * (m.n + n.n - o.c)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        )
        SELECT r.a AS doc_id, CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM reach r LEFT JOIN sizes s ON r.a = s.doc_id GROUP BY r.a
    """,
    "op11_conversation_repair": f"""
        WITH RECURSIVE {_CRC}, plain AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations
        ), marked AS (
            SELECT p.*, {_crc32("place")} % 20 AS z FROM plain p, crc_table
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN z = 4 THEN 'user' ELSE role END AS role, CASE z WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN z = 3 THEN [0, 1] ELSE [0] END) AS copy FROM marked WHERE z <> 0
        ), placed AS (
            SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text)) AS i FROM damaged
        ), faulty AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x09-\\x0D\\x20]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\\x09-\\x0D\\x20]*\\z') THEN 'truncated' ELSE '' END AS fault,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
        ), turns AS (
            SELECT *, fault NOT IN ('blank', 'duplicate') AS alive FROM faulty
        ), walk AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 't': '', 'n': CAST(0 AS BIGINT)}} AS v0,
                   CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR, n BIGINT)) AS v1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR, n BIGINT)) AS v2, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR, n BIGINT)) AS v3 FROM turns
            UNION ALL
            SELECT x.conv_id, x.i + 1, {_edit("w0", "4", "D", None)}, least({_edit("w1", "4", "D", None)}, {_kept("w0", "s")}),
                   least({_edit("w2", "4", "D", None)}, {", ".join(f(v, r) for v in ("w0", "w1", "w3") for f, r in ((_kept, "u"), (_renamed, "user")))}),
                   least({_edit("w3", "4", "D", None)}, {_kept("w2", "a")}, {_renamed("w2", "assistant")})
            FROM ({_INSERTED} walk)) x JOIN turns t ON x.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = x.i + 1
        ), ends AS (
            SELECT conv_id, least(w0, w3) AS best FROM ({_INSERTED} (SELECT * FROM walk QUALIFY i = max(i) OVER (PARTITION BY conv_id))))
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id
        ), ids AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
        FROM ids d LEFT JOIN counts c ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON d.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op12_importance_resampling": f"""
        WITH {_CRC}, d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), b AS (
            SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), dw AS (SELECT r, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
        hashed AS (
            SELECT word, {_crc32("word")} % 10000 AS k FROM (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)), crc_table
        ), s AS (SELECT k, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY k), t AS (SELECT k, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY k),
        sums AS (SELECT (SELECT count(*) FROM dw) AS ss, (SELECT count(*) FROM bw) AS tt),
        gain AS (
            SELECT h.k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE))) AS BIGINT) AS g
            FROM (SELECT DISTINCT k FROM hashed) h LEFT JOIN s ON h.k = s.k LEFT JOIN t ON h.k = t.k, sums
        ), weights AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (k) GROUP BY r),
        scored AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
            FROM d LEFT JOIN weights ON d.r = weights.r
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM ranked
    """,
}
