"""The operators as queries on the driver's tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from entry_queries.registry import query
from stratalake.llm import ann, bpe, chat, langid, licences, linedup, mixing, neardup, negatives, ngramjoin, phrases, quality, rules
from stratalake.llm.common import crc_remainder, table
from stratalake.session import keep

TOKENIZERS = "/opt/tokenizers"


def vocabulary(name: str, folder: str = TOKENIZERS) -> str:
    """Content of a public vocabulary file; the driver reads it, tasks get it by broadcast."""
    return Path(folder, name).read_text(encoding="utf-8")


def digest(rows: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded text."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary("word_bpe_49k.json")
    return digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), words), words))


@query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = keep(quality.described(table(spark, sf_dir, "documents"), "doc_id", "text"), "statistics")  # each text is read once
    scored = quality.score_described(stats, quality.fit_described(stats, table(spark, sf_dir, "labels")))
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@query("op8_rules")
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op9_chat")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    vocab = vocabulary("byte_bpe_50k.json")
    formatted = chat.format_turns(turns, vocab)
    read = chat.read_back(formatted, vocab, ["conv_id", "turn", "_role", "_text"])
    return chat.digests(read, "conv_id", ["turn", "_role", "_text"])


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
goal AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM ordered),
running AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN (budget // source_size) * size ELSE 0 END
            + least(greatest(CASE WHEN source_size > 0 THEN budget % source_size ELSE budget END - before, 0), size) AS BIGINT) AS taken
FROM running
"""


@query("op7_mixing", OP7_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op10_ann")
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
split AS (
  SELECT doc_id, generate_subscripts(string_split(low, chr(10)), 1) - 1 AS no, unnest(string_split(low, chr(10))) AS line, unnest(string_split(text, chr(10))) AS raw
  FROM docs),
worded AS (SELECT doc_id, no, raw, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM split),
tokens AS (
  SELECT DISTINCT doc_id, no, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) || CASE WHEN len(w) < 5 THEN '!' ELSE '' END AS t
  FROM worded WHERE len(w) > 0),
sizes AS (SELECT doc_id, no, count(*) AS n FROM tokens GROUP BY ALL),
common AS (
  SELECT x.doc_id AS xd, x.no AS xn, y.doc_id AS yd, y.no AS yn, count(*) AS c
  FROM tokens x JOIN tokens y ON x.t = y.t AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.no < x.no)
  GROUP BY ALL),
gone AS (
  SELECT DISTINCT xd AS doc_id, xn AS no FROM common
  JOIN sizes a ON a.doc_id = xd AND a.no = xn JOIN sizes b ON b.doc_id = yd AND b.no = yn
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
left_over AS (
  SELECT w.doc_id, string_agg(CASE WHEN g.no IS NULL THEN raw END, chr(10) ORDER BY w.no) AS text,
         count(*) FILTER (WHERE len(w) > 0) AS n_lines, count(g.no) AS n_removed
  FROM worded w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.no = w.no GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(l.text, '')) AS text_sha256
FROM documents d LEFT JOIN left_over l USING (doc_id)
"""


@query("op4_linedup", OP4_SQL)
def op4_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linedup.line_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 30),
inside AS (
  SELECT DISTINCT lang, a AS longer, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM c, (SELECT unnest([2, 3]) AS s), (SELECT unnest([1, 2, 3]) AS i) WHERE s < k AND i + s - 1 <= k),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100::HUGEINT * x.longer >= 80::HUGEINT * c.a)),
cuts AS (
  SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS left_part, array_to_string(w[i + 1:k], ' ') AS right_part
  FROM kept, (SELECT unnest([1, 2, 3]) AS i) WHERE i < k),
scored AS (
  SELECT x.lang, x.phrase, x.a, x.i, y.a AS l, z.a AS r, CAST((2000000::HUGEINT * x.a) // (y.a + z.a) AS BIGINT) AS score
  FROM cuts x JOIN f y ON y.lang = x.lang AND y.phrase = x.left_part JOIN f z ON z.lang = x.lang AND z.phrase = x.right_part),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op11_phrases", OP11_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT id, doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ') || '!']
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
  FROM worded),
classes AS MATERIALIZED (SELECT s, min(id) AS c, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS MATERIALIZED (SELECT c, len(s) AS n, unnest(s) AS t FROM classes),
links AS MATERIALIZED (
  SELECT x.c AS a, y.c AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.c <> y.c
  GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
found AS (SELECT r.a AS c, min(k.rep) AS component_id FROM reach r JOIN classes k ON k.c = r.b GROUP BY r.a)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(sets.s) = 0 THEN sets.doc_id ELSE found.component_id END AS component_id
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN found ON found.c = classes.c
"""


@query("op12_ngramjoin", OP12_SQL)
def op12_ngramjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_join(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH whole AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
width AS (SELECT len(v) AS w FROM whole GROUP BY len(v) ORDER BY count(*) DESC, w LIMIT 1),
vectors AS (SELECT whole.* FROM whole, width WHERE len(v) = w),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
"""


@query("op13_negatives", OP13_SQL)
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
