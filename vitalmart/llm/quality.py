"""Quality rules with cutoffs certified on labelled documents. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words_of

GRID = tuple(round(0.9 - 0.05 * i, 2) for i in range(18)) + (0.04, 0.03, 0.02)
LENGTHS = tuple(float(x) for x in range(60, 5, -2))
# Rule -> (numerator, denominator, cutoffs from lenient to strict). A text is rejected above the cutoff.
RULES = {
    "symbol_share": ("n_symbols", "word_chars", GRID),
    "dup_line_share": ("n_dup_lines", "n_lines", GRID),
    "repeat_share": ("n_repeat_words", "n_words", GRID),
    "upper_share": ("n_upper", "word_chars", GRID),
    "mark_share": ("n_marks", "n_words", GRID),
    "mean_word_length": ("word_chars", "n_words", LENGTHS),
}
BROADCAST_STRATA = 10_000


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, size: int = 5) -> Column:
    """Words inside runs of ``size`` words that occur twice or more, first occurrence included.

    Runs are 64-bit hashes; texts without a repeat stop after a hash-set test. Else the
    hashes are sorted with their places, equal neighbours give the repeated places, and the
    union of the runs is summed in order: n log n for a text of n words.
    """
    runs = lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)),
                                                           lambda i: F.xxhash64(F.slice(w, i, size)))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, j, k: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
        places = _let(placed, lambda s: F.array_sort(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(s, j, j - 1) | same(s, j, j + 1)),
            lambda j: F.get(s, j)["i"])))
        return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, p: F.struct(
            (acc["n"] + size - F.greatest(F.lit(0), acc["end"] - p)).alias("n"), (p + size).alias("end")), lambda acc: acc["n"])

    return _let(runs(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None) -> DataFrame:
    """One row of counts per input row: doc_id, stratum, n_words, word_chars, n_symbols, n_lines (lines
    with a word), n_dup_lines, n_repeat_words, n_upper, n_marks, base_failed. NULL text has none of all."""
    stratum = F.lit("all") if stratum is None else F.coalesce(stratum.cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    per_text = _let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeat_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    per_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    count = lambda c: F.regexp_count("text", F.lit(c))
    rows = rows.select("doc_id", "stratum", per_text.alias("w"), per_lines.alias("l"), count("[#*$%&|<>]").alias("n_symbols"),
                       count("[A-Z]").alias("n_upper"), count("[!?]").alias("n_marks"))
    names = ["w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words", "n_upper", "n_marks"]
    rows = rows.select("doc_id", "stratum", *(F.col(c).cast("bigint").alias(c.split(".")[-1]) for c in names))
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def value(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def allowed(n: Column, risk: float, error: Column) -> Column:
    """Most false rejections among n good texts for which the exact binomial test still shows a
    rate below ``risk``: the largest k with P(X <= k | n, risk) <= error, or -1.

    Equivalent to a Clopper-Pearson upper bound of at most ``risk``. The tail is summed in
    logarithms, so no n underflows; k cannot exceed n * risk.
    """
    step = math.log(risk) - math.log1p(-risk)
    n = n.cast("double")
    begin = F.struct((n * math.log1p(-risk)).alias("p"), F.lit(float("-inf")).alias("tail"), F.lit(-1).cast("bigint").alias("k"))

    def add(acc: Column, i: Column) -> Column:
        high, low = F.greatest(acc["p"], acc["tail"]), F.least(acc["p"], acc["tail"])
        tail = high + F.log1p(F.exp(low - high))
        return F.struct((acc["p"] + F.log((n - i) / (i + 1)) + step).alias("p"), tail.alias("tail"),
                        F.when(tail <= F.log(error), i).otherwise(acc["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.floor(n * risk).cast("bigint")), begin, add, lambda acc: acc["k"])


def certify(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: Column | None = None,
            risk: float = 0.03, error: float = 0.05) -> DataFrame:
    """Cutoffs (stratum, rule, cutoff, n_good, rejected) from labelled texts.

    All good texts (default quality = 1; of conflicting labels the worst counts) that pass the
    base rules are the holdout: the rules have no other fitted part. In each stratum a
    rule gets the strictest cutoff on its grid whose exact binomial bound keeps the rate of
    rejected good texts within risk / rules. Counts only grow along the grid, so testing from
    lenient to strict and stopping at the first failure costs no error (fixed sequence); the
    error is shared over rules and strata (Bonferroni). With probability 1 - error no stratum
    loses more than ``risk`` of its good texts to all rules together. A rule that cannot be
    certified has no row and rejects nothing. Unlabelled ids, NULL ids and NULL labels are out.
    """
    good = F.col("quality") == 1 if good is None else good
    marked = labels.select(F.col(id_col).alias("doc_id"), F.coalesce(good, F.lit(False)).alias("good")).where(
        "doc_id is not null").groupBy("doc_id").agg(F.min("good").alias("good")).where("good")
    held = counts.where("not base_failed").join(marked.select("doc_id"), "doc_id", "left_semi")
    grid = lambda r: F.array(*(F.lit(float(c)) for c in RULES[r][2]))

    def first(rule: str) -> Column:
        """Place on the grid from which on the cutoffs reject this text; all later ones do, too."""
        return F.size(grid(rule)) - F.size(F.filter(grid(rule), lambda c: value(rule) > c))

    firsts = F.array(*(F.struct(F.lit(r).alias("rule"), first(r).alias("first")) for r in RULES))
    steps = held.select("stratum", F.explode(firsts).alias("s")).groupBy("stratum", "s.rule", "s.first").agg(F.count("*").alias("n"))
    # from here on strata x rules x grid rows
    total = steps.groupBy("stratum", "rule").agg(F.sum("n").alias("n_good"), F.collect_list(F.struct("first", "n")).alias("steps"))
    strata = total.agg(F.countDistinct("stratum").alias("strata"))
    total = total.crossJoin(F.broadcast(strata)).withColumn(
        "allowed", allowed(F.col("n_good"), risk / len(RULES), F.lit(error) / (F.col("strata") * len(RULES))))
    cutoffs = F.element_at(F.create_map(*(x for r in RULES for x in (F.lit(r), grid(r)))), F.col("rule"))
    rows = total.select("stratum", "rule", "n_good", "allowed", "steps", F.posexplode(cutoffs).alias("at", "cutoff"))
    rejected = F.aggregate("steps", F.lit(0).cast("bigint"), lambda acc, s: acc + F.when(s["first"] <= F.col("at"), s["n"]).otherwise(0))
    rows = rows.withColumn("rejected", rejected).where("rejected <= allowed")
    return rows.groupBy("stratum", "rule", "n_good").agg(F.min_by(F.struct("cutoff", "rejected"), "cutoff").alias("best")).select(
        "stratum", "rule", "best.cutoff", "n_good", "best.rejected")


def judge(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """counts with ``rejected_by`` (rules whose certified cutoff is exceeded) and ``kept``."""
    wide = stored(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "cutoffs")
    if wide.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        wide = F.broadcast(wide)  # else a shuffled join, whose hot strata adaptive execution splits
    fails = F.array_compact(F.array(*(F.when(value(r) > F.element_at("cutoffs", F.lit(r)), F.lit(r)) for r in RULES)))
    rows = counts.join(wide, "stratum", "left").withColumn("rejected_by", F.coalesce(fails, F.array().cast("array<string>")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("cutoffs")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum: Column | None = None, risk: float = 0.03, error: float = 0.05) -> DataFrame:
    """One row per input row: the counts, base_failed, rejected_by and kept.

    NULL and word-less texts have zero words and fail the base rules; repeated rows and NULL
    ids are judged like others; a NULL stratum is a stratum of its own. Empty labels certify
    nothing, so only the base rules reject.
    """
    counts = stored(features(docs, id_col, text_col, stratum), "features")
    return judge(counts, certify(counts, labels, risk=risk, error=error))
