"""The numbered operators bound to their whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, centroids, chat, fingerprint, html_text, jaccard, language, lines, mixing, pieces, quality, secrets, spelling,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


#: The vocabulary file of op9.
RANKS = "byte_bpe_multi_50k.tiktoken"

@query("op1_secret_scan")
def op1(spark, sf):
    return secrets.scan(table(spark, sf, "documents"))


_ASCII_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         md5('17:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 3 * source_size AS cap,
         (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (
            ORDER BY 3 * source_size / w, w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_total,
         sum(w) OVER (ORDER BY 3 * source_size / w, w, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
  FROM s),
lv AS (
  SELECT max(CASE WHEN cap * rest_w > w * rest_total
                  THEN CAST(rest_total AS DOUBLE) / CAST(rest_w AS DOUBLE) END) AS level FROM o),
t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(w * level, CAST(cap AS DOUBLE))) AS target
  FROM o, lv),
p AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole_reps
  FROM t),
r AS (
  SELECT d.doc_id, d.source, size, source_size, target, whole_reps,
         CAST(floor(target - whole_reps * source_size) AS BIGINT) AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, size, doc_id) AS running
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
e0 AS (SELECT *, CASE WHEN running <= rest THEN 1 ELSE 0 END AS extra0 FROM r),
g1 AS (SELECT source, max(rest) - sum(size * extra0) AS gap FROM e0 GROUP BY source),
b1 AS (
  SELECT e0.source, max({{'size': size, 'doc': doc_id}}).doc AS best
  FROM e0 JOIN g1 ON e0.source IS NOT DISTINCT FROM g1.source
  WHERE extra0 = 0 AND size > 0 AND whole_reps * source_size < target AND size <= gap GROUP BY e0.source),
e1 AS (SELECT e0.*, CASE WHEN doc_id IN (SELECT best FROM b1) THEN 1 ELSE extra0 END AS extra1 FROM e0),
g2 AS (SELECT source, max(rest) - sum(size * extra1) AS gap FROM e1 GROUP BY source),
b2 AS (
  SELECT e1.source, max({{'off': -abs(size - gap), 'size': size, 'doc': doc_id}}).doc AS best
  FROM e1 JOIN g2 ON e1.source IS NOT DISTINCT FROM g2.source
  WHERE extra1 = 0 AND size > 0 AND whole_reps * source_size < target AND abs(size - gap) < gap GROUP BY e1.source),
e2 AS (SELECT e1.*, CASE WHEN doc_id IN (SELECT best FROM b2) THEN 1 ELSE extra1 END AS extra2 FROM e1)
SELECT doc_id, size, source_size, target, CAST(least(whole_reps + extra2, 3) * size AS BIGINT) AS taken FROM e2
"""


@query("op2_source_mix", OP2_SQL)
def op2(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
r AS (
  SELECT doc_id, CAST(sum(least(8, nxt - i)) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 8) AS nxt FROM c WHERE n > 1)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS lines,
         length(t) - length(replace(t, '!', '')) AS bangs,
         len(list_filter(w, lambda x: list_contains([{_STOPS}], lower(x)))) AS stops,
         len(list_filter(list_zip(w, w[2:]), lambda x: x[1] = x[2])) AS adjacent
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols / n_words <= 0.1 AND bangs / n_words <= 0.3
       AND (n_words < 30 OR stops / n_words >= 0.04) AND adjacent / n_words <= 0.3
       AND n_dup_lines / greatest(lines, 1) <= 0.5 AND word_chars / n_words <= 15.0 AS kept
FROM b
"""


@query("op3_quality_rules", OP3_SQL)
def op3(spark, sf):
    judged = quality.quality(table(spark, sf, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op4_fingerprint")
def op4(spark, sf):
    return fingerprint.fingerprint(table(spark, sf, "documents"))


@query("op5_ngram_jaccard")
def op5(spark, sf):
    return jaccard.jaccard_components(table(spark, sf, "documents").select("doc_id", "text"))


@query("op6_language_id")
def op6(spark, sf):
    """Learned from the four folds whose crc32 is not divisible by five."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    found = language.identify(docs, docs.filter(~held_out))
    return found.select("doc_id", held_out, "lang_pred", "score")


@query("op7_html_text")
def op7(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (
  SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS n_text,
         length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '%', '%25'), chr(10), '%0A')) AS n_role
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(n_text + n_role + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op8_chat_format", OP8_SQL)
def op8(spark, sf):
    turns = chat.conversations_with_probe(spark, sf).withColumn(
        "parts", chat.text_part(F.coalesce("text", F.lit("")))
    )
    read = chat.parse_chat(chat.format_chat(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read.withColumn("_loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_byte_bpe")
def op9(spark, sf):
    return bpe.encode_documents(
        table(spark, sf, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^{_ASCII_SPACE}+|{_ASCII_SPACE}+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d)),
k AS (
  SELECT key, max(doc_id) AS last FROM e WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (last IS NOT NULL AND doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM e LEFT JOIN k USING (key) GROUP BY doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark, sf):
    kept = lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Two words are near where one is the other without a letter, or both are the same without
#: their letter at one place.  The polynomial is the reflected one of crc32 (fixed value).
OP11_SQL = r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
      FROM documents),
o AS (SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS bytes FROM d GROUP BY doc, run),
h AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || bytes[2 * i + 1:2 * i + 2] AS BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM o, tab),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                   ELSE run END AS word FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
v AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS part
  FROM (SELECT *, CAST(unnest(range(length(word))) AS BIGINT) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM v a JOIN v b USING (i, part) WHERE a.word <> b.word
  UNION SELECT v.word, w.word, w.n FROM v JOIN w ON w.word = v.part
  UNION SELECT w.word, v.word, v.n FROM v JOIN w ON w.word = v.part),
f AS MATERIALIZED (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n
  FROM p GROUP BY word),
l AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
         CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN f USING (word)),
r AS (
  SELECT word, coalesce(form, word) AS at, form IS NULL AS done FROM l
  UNION ALL
  SELECT r.word, coalesce(l.form, r.at), l.form IS NULL FROM r JOIN l ON l.word = r.at WHERE NOT done)
SELECT l.word, l.form, r.at AS root, l.n, l.n_near, l.form_n FROM l JOIN r ON r.word = l.word AND r.done
"""


@query("op11_spelling_variants", OP11_SQL)
def op11(spark, sf):
    counted = spelling.word_counts(table(spark, sf, "documents"))
    return spelling.group_variants(counted)


def _op12_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    far = f"CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, x, arg_min(j, (dist, j)) AS cluster, min(dist) AS distance
  FROM (SELECT row, vec_id, x, j, {far} AS dist FROM v, c{r}) GROUP BY row, vec_id, x),
c{r + 1} AS MATERIALIZED (
  SELECT j, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
      FROM a{r}, (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY cluster, i) GROUP BY cluster) m
  ON m.cluster = j)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS INTEGER) AS j, x AS c
  FROM v ORDER BY sha256('2:' || vec_id), x LIMIT {k}),
{", ".join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON j = cluster
"""


@query("op12_centroid_clusters", _op12_sql())
def op12(spark, sf):
    return centroids.cluster(table(spark, sf, "embeddings"))


#: The model file of op13.
MODEL = "piece_bpe_32k.model"


@query("op13_sentencepiece")
def op13(spark, sf):
    return pieces.encode_pieces(table(spark, sf, "documents"), public_tokenizers.path(MODEL))
