"""The operators as queries over the sample tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, hmm, langid, lines, mixing, periodic, phrases, quality, resampling, secrets, simhash,
               whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    """Path of the public ranks file and the pre-token pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_simhash_pivot")
def op1_simhash_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_decontamination_index", """
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, sizes WHERE len(w) >= n)),
matches AS (SELECT p.doc_id, m.item_id, p.i, p.n FROM places p JOIN windows m ON p.n = m.n AND p.phrase = m.phrase),
hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM matches) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM tokens t LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op9_decontamination_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), reach=0)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op9_decontamination_proximity")
def op9_decontamination_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the method at the operator's reach: the columns of op9_decontamination_index, whose
    SQL names exactly those, and the items with proximity matches only."""
    rows = phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                       F.array_join("near_items", ",").alias("near_items"))


@query("op5_bpe_two_tier")
def op5_bpe_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), *vocabulary())


@query("op6_secret_links")
def op6_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def _quality_sql(risk: float = 0.03, error: float = 0.05) -> str:
    words = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
    kept_chars = lambda c: f"CAST(length(regexp_replace(coalesce(text, ''), '[^{c}]', '', 'g')) AS BIGINT)"
    rules = " UNION ALL ".join(
        f"SELECT doc_id, stratum, base_failed, '{r}' AS rule, CASE WHEN {b} > 0 THEN {t} / {b} ELSE 0 END AS v FROM counts"
        for r, (t, b, _) in quality.RULES.items())
    grid = ", ".join(f"('{r}', CAST({c} AS DOUBLE))" for r, (_, _, cs) in quality.RULES.items() for c in cs)
    share, n_rules = risk / len(quality.RULES), len(quality.RULES)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS stratum, text, {words} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
runs AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS run
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)),
repeated AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM repeated) GROUP BY doc_id),
counts AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM (
    SELECT t.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      {kept_chars('#*$%&|<>')} AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
      {kept_chars('A-Z')} AS n_upper, {kept_chars('!?')} AS n_marks
    FROM texts t LEFT JOIN covered c USING (doc_id))),
vals AS ({rules}),
grid(rule, cutoff) AS (VALUES {grid}),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING bool_and(coalesce(quality = 1, false))),
held AS (SELECT * FROM vals WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
sizes AS (SELECT stratum, count(*) / {n_rules} AS n, count(DISTINCT stratum) OVER () AS strata FROM held GROUP BY stratum),
tails AS (
  SELECT stratum, k, strata, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({share}) + (n - k) * ln(1 - {share})))
    OVER (PARTITION BY stratum ORDER BY k) AS tail
  FROM (SELECT *, unnest(range(0, CAST(floor(n * {share}) AS BIGINT) + 1)) AS k FROM sizes)),
allowed AS (SELECT stratum, max(k) AS k FROM tails WHERE tail <= {error} / (strata * {n_rules}) GROUP BY stratum),
tested AS (SELECT h.stratum, h.rule, cutoff, count(*) FILTER (WHERE v > cutoff) AS rejected
  FROM held h JOIN grid g ON h.rule = g.rule GROUP BY ALL),
cutoffs AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tested JOIN allowed USING (stratum) WHERE rejected <= k GROUP BY ALL),
failed AS (SELECT DISTINCT doc_id FROM vals JOIN cutoffs USING (stratum, rule) WHERE v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM counts"""


@query("op7_quality_certified", _quality_sql())
def op7_quality_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), stratum=F.col("lang"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_language_codes")
def op4_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


@query("op2_hmm_scores")
def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@query("op3_line_similarity", """
WITH cuts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, ln, ls[ln] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS ln FROM cuts)),
sets AS (SELECT doc_id, ln, row_number() OVER (ORDER BY doc_id, ln) AS id, w, len(w) AS n
  FROM (SELECT doc_id, ln, list_distinct(regexp_extract_all(lower(line), '[^\\x20\\x09-\\x0D]+')) AS w FROM lines) WHERE len(w) > 0),
tokens AS (SELECT id, n, unnest(w) AS tok FROM sets),
rarity AS (SELECT tok, count(*) AS df FROM tokens GROUP BY tok),
prefix AS (SELECT id, n, tok FROM (
  SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY df, tok) AS place FROM tokens JOIN rarity USING (tok))
  WHERE place <= n - CAST(ceil(n * 4 / 5.0) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.tok = b.tok AND a.id < b.id
  AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT pairs.b AS id FROM pairs JOIN sets x ON x.id = pairs.a JOIN sets y ON y.id = pairs.b
  WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)),
marked AS (SELECT l.doc_id, l.ln, line, s.id IS NOT NULL AS worded, g.id IS NOT NULL AS removed
  FROM lines l LEFT JOIN sets s ON l.doc_id = s.doc_id AND l.ln = s.ln LEFT JOIN gone g ON s.id = g.id),
kept AS (SELECT doc_id, CAST(count(*) FILTER (WHERE worded) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE removed) AS BIGINT) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (WHERE NOT removed), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, k.text FROM documents d LEFT JOIN kept k USING (doc_id)
""")
def op3_line_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_removed").cast("bigint").alias("n_removed"), "text")


@query("op8_preference_pairs", """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
talks AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS ts FROM turns GROUP BY conv_id),
pairs AS (SELECT conv_id // 2 AS pair_id, max(conv_id) FILTER (WHERE conv_id % 2 = 0) AS c, max(conv_id) FILTER (WHERE conv_id % 2 = 1) AS r
  FROM turns GROUP BY 1),
both_sides AS (SELECT pair_id, coalesce(x.ts, []) AS a, coalesce(y.ts, []) AS b FROM pairs LEFT JOIN talks x ON x.conv_id = c LEFT JOIN talks y ON y.conv_id = r),
same AS (SELECT *, list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]) AS s FROM both_sides),
cut AS (SELECT *, CAST(CASE WHEN list_contains(s, false) THEN list_position(s, false) - 1 ELSE len(s) END AS INT) AS n FROM same),
drawn AS (SELECT pair_id, n,
    list_transform(a[1:n], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS p,
    list_transform(a[n + 1:], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS c,
    list_transform(b[n + 1:], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS r,
    a[n + 1:] AS ca, b[n + 1:] AS rb FROM cut)
SELECT pair_id, n AS n_prompt_turns, array_to_string(p, '') AS prompt, array_to_string(c, '') AS chosen, array_to_string(r, '') AS rejected,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: ca[i].role = 'assistant'), lambda i:
    (length(array_to_string(c[1:i - 1], '')) + 14)::VARCHAR || ':' || length(array_to_string(c[1:i], ''))::VARCHAR), ',') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: rb[i].role = 'assistant'), lambda i:
    (length(array_to_string(r[1:i - 1], '')) + 14)::VARCHAR || ':' || length(array_to_string(r[1:i], ''))::VARCHAR), ',') AS rejected_mask
FROM drawn
""")
def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table names no preferences: conversation 2k stands as chosen, 2k + 1 as rejected of pair k."""
    turns = table(spark, sf_dir, "conversations")
    half = F.col("conv_id").cast("bigint")
    pairs = turns.where("conv_id is not null and turn is not null").groupBy(F.expr("conv_id div 2").alias("pair_id")).agg(
        F.max(F.when(half % 2 == 0, half)).alias("chosen_id"), F.max(F.when(half % 2 == 1, half)).alias("rejected_id"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return chat.preference_examples(turns, pairs).withColumns({c: listed(c) for c in ("chosen_mask", "rejected_mask")})


@query("op10_importance_resampling")
def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return resampling.resample(table(spark, sf_dir, "documents"), good)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.periodic_runs(table(spark, sf_dir, "documents"), planted_tails=True, texts=False)
    # of the longest runs the first, of those the shortest period: the listing is in that order
    longest = F.array_max(F.transform("runs", lambda r: r["length"]))
    first = F.filter("runs", lambda r: r["length"] == F.col("longest"))
    return rows.withColumn("longest", longest).withColumn("run", F.try_element_at(first, F.lit(1))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "run.start", "run.length", "run.period",
        F.expr("run.length * 1000 div run.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("bigint"))


@query("op13_source_mix", """
WITH sizes AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sources),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE) AS rest,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS weights
  FROM weighed WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, bool_and(rest * weight / weights > 3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
    ROWS UNBOUNDED PRECEDING) AS full_up FROM filled),
shared AS (SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (WHERE full_up), 0) AS rest,
    sum(weight) FILTER (WHERE NOT full_up) AS weights FROM capped),
targets AS (SELECT source, source_size, CASE WHEN full_up THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(s.rest AS DOUBLE) * weight / CAST(s.weights AS DOUBLE) END AS target FROM capped, shared s),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
placed AS (SELECT d.doc_id, d.size, b.*, target - whole * source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM sizes d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN before < rest AND rest - before >= size / 2 THEN 1 ELSE 0 END) AS taken
FROM placed
""")
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
