"""One query for each operator over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, decontaminate, hard_negatives, language_id, line_crf, line_dedup, mixing, near_dedup, periodic_runs, quality_rules, token_files, tokens, warc
from .common import scratch_path, table, words_of


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids are in fold 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words and fail; rows that repeat an id are judged each; null sources are one host; an empty table gives an empty one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = quality_rules.judge(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts stay null; rows with a null id are left as they are; an empty table gives an empty one."""
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and wordless texts are linked with nothing; null ids are left out; an empty table gives an empty one."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), n=2)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null html is an empty payload, a null page_id serves no other page; repeated rows come back each."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.capture_digests(warc.assemble(warc.read_records(spark, path, with_payload=False)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have size 0; null sources are one source, the last; rows that repeat an id are taken alike."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix(docs)
    return out.selectExpr("doc_id", "mix_size AS size", "source_size", "target", "copies * mix_size AS taken")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty; texts are encoded whole in parts that change no token; repeated rows are counted each."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are one end; rows with a null id are scored each; words and counts are of all training rows."""
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = attention_lm.score(docs, fold(F.col("_id"), 5) != 1, (P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    return out.withColumn("held_out", fold(F.col("doc_id"), 5) == 1)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words, null items no windows; repeated rows are scanned each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have a score too; rows without labels are scored like all others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = line_crf.train(docs, labels, usable=lambda c: fold(c, 4) != 2)
    out = line_crf.score(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts, and those without a letter, are und; null ids are in fold 0 and so never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(fold(F.col("doc_id"), 5) != 0))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without vec_id, label, vector or a finite component take no part; of rows that repeat a vec_id the least counts."""
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are the end id alone; null ids come first; rows that repeat an id come one after the other."""
    import public_tokenizers

    path, tokenizer = scratch_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer, end_id=2)
    out = token_files.read_token_files(spark, path, token_files.WordEncoder(tokenizer).vocabulary)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words, no runs and the hashes of the empty string; a null id is the empty string in h."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    g, n = F.floor(F.col("h") / 10), F.size("w").cast("long")
    d = d.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.lit(1).cast("long") + F.floor((n - F.col("a")) / (3 + g % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(F.col("w"), source(i).cast("int")))
    d = d.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
    out = periodic_runs.collapse_runs(d).withColumn("best", periodic_runs.longest_run(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_language_id": op8_language_id,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_files": op12_token_files,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
x AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM p),
c AS (SELECT doc_id, win FROM x GROUP BY doc_id, win HAVING count(*) > 1),
y AS (SELECT x.doc_id, x.i FROM x JOIN c ON x.doc_id = c.doc_id AND x.win = c.win),
z AS (SELECT doc_id, count(DISTINCT q) AS n_rep FROM (SELECT doc_id, unnest(range(i, i + 3)) AS q FROM y) GROUP BY doc_id),
f AS (SELECT d.doc_id, d.source, CAST(len(d.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
        CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN z ON d.doc_id = z.doc_id),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * n_lines AS failed FROM f),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) AS DOUBLE) AS k FROM g GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE 10.0 END AS s FROM m),
r AS (SELECT source, (k + m * s) / (n + s) > 0.5 AS rejected FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT failed AND NOT rejected AS kept
FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source""",
    "op4_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest AND p.n = g.n""",
    "op5_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE r % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
l AS (SELECT *, (CAST(total AS DOUBLE) * CAST(1.5 AS DOUBLE) - CAST(capped AS DOUBLE) * CAST(2 AS DOUBLE)) / open AS level FROM o),
m AS (SELECT *, max(CASE WHEN NOT (2 * source_size <= level * w) THEN level END) OVER () AS lev FROM l),
t AS (SELECT source, source_size, CASE WHEN 2 * source_size <= level * w THEN CAST(2 * source_size AS DOUBLE)
        ELSE least(CAST(2 * source_size AS DOUBLE), lev * w) END AS target FROM m),
b AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
x AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.passes, b.target - b.passes * b.source_size AS room,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(d.size) OVER (PARTITION BY d.source, d.h) AS grp
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN passes < 2 AND (upto <= room OR upto - grp <= room AND upto - room < room - (upto - grp)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x""",
    "op10_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 13) AS k FROM bw WHERE len(w) > 0),
bp AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM bn),
bx AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS win FROM bp),
ks AS (SELECT DISTINCT k FROM bx),
dk AS (SELECT doc_id, w, k FROM dw JOIN ks ON len(dw.w) >= ks.k),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dk),
dx AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM dp),
hits AS (SELECT dx.doc_id, dx.k, dx.p, bx.item_id FROM dx JOIN bx ON dx.win = bx.win AND dx.k = bx.k),
pos AS (SELECT DISTINCT doc_id, k, p FROM hits),
hp AS (SELECT doc_id, unnest(range(p, p + k)) AS q FROM pos),
nh AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hp GROUP BY doc_id),
it AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits),
ni AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM it GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN nh ON dw.doc_id = nh.doc_id LEFT JOIN ni ON dw.doc_id = ni.doc_id""",
    "op11_hard_negatives": """
WITH r AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score FROM a JOIN r ON a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
