"""Near-duplicate lines removed by an exact set-similarity join. Built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.operators.windows import number_rows

from .common import discard, split_at_spaces, stored, words_of

SKETCH_BITS = 18  # rarity is counted in 2**SKETCH_BITS buckets of token hashes, whatever the vocabulary
HOT = 1000
SLICES = 2  # parts of a join, one after the other
_LOW = 64 - SKETCH_BITS
_WORD = "[^\\x20\\x09-\\x0D]"


def tokens_of(line: Column) -> Column:
    """The set of a line's words in lower case."""
    return F.array_distinct(words_of(F.lower(line)))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def rarity(hashes: DataFrame) -> DataFrame:
    """One row: for each bucket of token hashes (their top bits) its place when sorted by count,
    already shifted to where the top bits stand.

    ``hashes`` has one row per token of a line (column h). The buckets are a fixed number, so
    the window and the array are bounded.
    """
    buckets = hashes.select(F.shiftrightunsigned("h", _LOW).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    every = hashes.sparkSession.range(1 << SKETCH_BITS).select(F.col("id").alias("bucket"))
    place = F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "bucket")).cast("bigint") - 1 - (1 << (SKETCH_BITS - 1))
    ranked = every.join(F.broadcast(buckets), "bucket", "left").select("bucket", F.shiftleft(place, _LOW).alias("rank"))
    return ranked.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "rank"))), lambda x: x["rank"]).alias("ranks"))


def _hashes(line: Column) -> Column:
    """The set of a line's tokens as 64-bit hashes."""
    parts = F.transform(split_at_spaces(F.lower(line)), lambda t: F.xxhash64(t))
    return F.array_remove(F.array_distinct(parts), F.xxhash64(F.lit("")))


def _keys(hashes: Column, ranks: Column) -> Column:
    """Token hashes with the top bits replaced by their bucket's rank, ascending: rare tokens
    first. Ranks permute the buckets, so no bit of the hash is lost."""
    key = lambda h: F.coalesce(F.get(ranks, F.shiftrightunsigned(h, _LOW).cast("int")), F.lit(0).cast("bigint")).bitwiseOR(
        h.bitwiseAND(F.lit((1 << _LOW) - 1)))
    return F.sort_array(F.transform(hashes, key))


def _signature(keys: Column, half: int) -> Column:
    """One half of 128 parities of the tokens' low bits: two signatures differ in no more bits than their sets in tokens."""
    mine = lambda k: F.shiftright(k if half else F.bitwise_not(k), 6).bitwiseAND(F.lit(1).cast("bigint"))
    bit = lambda k: F.call_function("shiftleft", mine(k), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(keys, F.lit(0).cast("bigint"), lambda acc, k: acc.bitwiseXOR(bit(k)))


def prefixes(lines: DataFrame, ranks: DataFrame, num: int, den: int) -> DataFrame:
    """Each line (id, hashes) with the tokens of its prefix, the rarest ones: two lines at Jaccard num/den share one there.

    Beside them what the filters of the join need: number of tokens and the halves of a signature. All is made
    once per line, before its tokens become rows.
    """
    n = F.size("keys")
    prefix = n - F.ceil(n * num / den).cast("int") + 1
    made = _let(_keys(F.col("hashes"), F.col("ranks")), lambda k: F.struct(
        k.alias("keys"), _signature(k, 0).alias("sig"), _signature(k, 1).alias("sig2")))
    sized = lines.withColumn("ranks", ranks.scalar()).select("id", made.alias("made")).select("id", "made.*")
    return sized.select("id", n.alias("n"), "sig", "sig2", F.slice("keys", F.lit(1), prefix).alias("prefix"))


def _rows(lines: DataFrame) -> DataFrame:
    """A row per token of each prefix, with its place there."""
    return lines.select("id", "n", "sig", "sig2", F.posexplode("prefix").alias("at", "key"))


def prefix_rows(lines: DataFrame, ranks: DataFrame, num: int, den: int) -> DataFrame:
    return _rows(prefixes(lines, ranks, num, den))


def _close(x, y, num: int, den: int) -> Column:
    """Length, position (tokens left after the shared one) and signature filters. Both halves count together: 64
    parities of two lines of 130 tokens and more differ in about 32 bits, which is never too many for such lines."""
    both = x("n") + y("n")
    least = F.ceil(both * num / (num + den))
    differ = F.bit_count(x("sig").bitwiseXOR(y("sig"))) + F.bit_count(x("sig2").bitwiseXOR(y("sig2")))
    return (F.greatest(x("n"), y("n")) * num <= F.least(x("n"), y("n")) * den) & (
        F.least(x("n") - x("at"), y("n") - y("at")) >= least) & (differ <= both - 2 * least)


def _slices(rows: DataFrame, by: str = "key") -> list[DataFrame]:
    """Rows in parts by a column, joined one after the other: a join then keeps only a part of
    the rows in shuffle files."""
    return [rows.where(F.pmod(F.xxhash64(by), F.lit(SLICES)) == k) for k in range(SLICES)]


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()


def earliest_candidates(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (early, late) of each line with the earliest line under each of its prefix tokens.

    At most one per line and token, so lines that all resemble each other give pairs in proportion
    to their number. A token's rows are summed up before they are shuffled; those of tokens with more than
    1/HOT of all rows (fewer than HOT tokens) meet their earliest line where they lie.
    """
    total, found = rows.count(), []
    x, y = (lambda c: F.col(f"head.{c}")), F.col
    for part in _slices(rows):
        first = [F.min("id").alias("id"), *(F.min_by(c, "id").alias(c) for c in ("n", "sig", "sig2", "at"))]  # not of a struct: that sorts all rows
        heads = part.groupBy("key").agg(*first, F.count("*").alias("lines")).where("lines > 1")
        heads = stored(heads.select("key", F.struct("id", "n", "sig", "sig2", "at").alias("head"), "lines"), "heads")
        hot = F.broadcast(heads.where(F.col("lines") * HOT > F.lit(total)))
        cool = part.join(hot.select("key"), "key", "left_anti").join(heads, "key")
        near = part.join(hot, "key").unionByName(cool).where((x("id") < y("id")) & _close(x, y, num, den))
        found.append(stored(near.select(x("id").alias("early"), y("id").alias("late")), "earliest"))
        discard(heads)
    return _united(found)


def candidates(rows: DataFrame, late: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs (early, late) that pass the filters, of the ``late`` rows with all before them."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    found = []
    for a, b in zip(_slices(rows), _slices(late)):
        pairs = a.alias("x").join(b.alias("y"), (x("key") == y("key")) & (x("id") < y("id")) & _close(x, y, num, den))
        found.append(stored(pairs.select(x("id").alias("early"), y("id").alias("late")).distinct(), "pairs"))
    return _united(found)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """One row per input row: ``row`` (the input's columns), n_lines, n_removed, text (lines left).

    Lines are cut at \\n; their tokens are the set of their words in lower case. A line is removed
    when an earlier line has a Jaccard similarity of num/den or more with it, the lines of the
    corpus being ordered by document id (NULL last), text hash and line number; whether that
    one is itself removed does not matter. Lines without a word stay and count for nothing. NULL
    texts stay NULL. Rows equal in id and text are one document listed twice: both keep the
    same lines. Tokens are compared by 64-bit hashes in the join and as strings when verified.

    Equal lines are one line of the join (its first occurrence), so a line that holds a third of
    all rows is one row per task before the shuffle and one row after. One earlier match settles
    a line, so each is first held against the earliest line under each of its prefix tokens; only lines
    that this does not settle are joined with all lines before them.
    """
    docs = docs.select(F.struct(*docs.columns).alias("row")).select("row", F.xxhash64(f"row.{id_col}").alias("kd"),
                                                                    F.xxhash64(f"row.{text_col}").alias("th"))
    doc, body = F.col("row")[id_col], F.col("row")[text_col]
    cut = docs.select(doc.alias("doc"), "kd", "th", F.posexplode(F.split(body, "\n")).alias("ln", "line")).where(F.col("line").rlike(_WORD))
    order = ["last", "doc", "th", "ln", "kd"]
    firsts = cut.groupBy(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")).agg(
        F.min(F.struct(F.col("doc").isNull().alias("last"), *order[1:])).alias("o")).select("o.*")
    # the number of a line in that order is its id: ids compare as lines do
    firsts = stored(number_rows(firsts, [], order, "id").select("kd", "th", "ln", "id"), "lines")
    own = firsts.groupBy("kd", "th").agg(F.collect_list(F.struct("ln", "id")).alias("own"))
    # for rarity a word counts as often as it occurs: any order of the tokens gives the same result
    lowered = cut.select(F.lower("line").alias("line")).select(F.explode(split_at_spaces(F.col("line"))).alias("word"))
    ranks = stored(rarity(lowered.select(F.xxhash64("word").alias("h"))), "rarity")

    # A document listed several times is read once. The order names all columns, so that this and
    # the last join ask for the same columns and can share one shuffle of the texts.
    once = docs.withColumn("copy", F.row_number().over(Window.partitionBy("kd", "th").orderBy(
        *(F.col("row")[c] for c in docs.schema["row"].dataType.names if c != text_col)))).where("copy = 1")

    def lines_at(numbers: DataFrame, column: str, words) -> DataFrame:
        """id and words of the listed lines (ln, id) of each document."""
        found = _let(F.split(body, "\n"), lambda cuts: F.transform(column, lambda i: F.struct(
            i["id"].alias("id"), words(F.get(cuts, i["ln"])).alias("words"))))
        return once.join(numbers, ["kd", "th"]).select(F.explode(found).alias("l")).select("l.id", "l.words")

    def alike(pairs: DataFrame) -> DataFrame:
        """Ids of late lines of pairs that really are alike, verified on words, slice by slice: pairs carry
        the words of both lines when they are held against each other. They travel as one string, which takes
        a fraction of an array of strings in shuffle files, and are cut where they meet."""
        ends = pairs.select(F.explode(F.array("early", "late")).alias("id")).distinct()
        asked = firsts.join(ends, "id").groupBy("kd", "th").agg(F.collect_list(F.struct("ln", "id")).alias("asked"))
        words = lines_at(asked, "asked", tokens_of).select("id", F.size("words").alias("n"), F.array_join("words", " ").alias("words"))
        words = stored(words, "words")
        shared, found = F.size(F.array_intersect(F.split("early_words", " "), F.split("late_words", " "))), []
        for part in _slices(pairs, "late"):
            for end in ("early", "late"):
                part = part.join(words.select(F.col("id").alias(end), F.col("n").alias(f"{end}_n"), F.col("words").alias(f"{end}_words")), end)
            same = part.where(shared * (num + den) >= (F.col("early_n") + F.col("late_n")) * num)
            found.append(stored(same.select(F.col("late").alias("id")).distinct(), "alike"))
        discard(words)
        return _united(found)

    sets = stored(prefixes(lines_at(own, "own", _hashes).withColumnRenamed("words", "hashes"), ranks, num, den), "prefixes")
    early = stored(earliest_candidates(_rows(sets), num, den), "earliest")
    settled = stored(alike(early), "settled")
    late = sets.join(settled, "id", "left_anti")
    pairs = stored(candidates(_rows(sets), _rows(late), num, den), "pairs")
    discard(sets, ranks, early)
    others = stored(alike(pairs), "others")
    discard(pairs)
    gone = firsts.join(settled.union(others), "id").groupBy("kd", "th").agg(F.collect_list("ln").alias("gone"))

    def outcome(cuts: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(cuts) - 1)
        worded = F.filter(numbers, lambda i: F.get(cuts, i).rlike(_WORD))
        again = F.array_except(worded, F.coalesce("own.ln", F.array().cast("array<int>")))
        every = F.array_union(again, F.coalesce("gone", F.array().cast("array<int>")))
        return _let(every, lambda g: F.struct(F.size(worded).alias("n_lines"), F.size(g).alias("n_removed"), F.array_join(
            F.transform(F.array_except(numbers, g), lambda i: F.get(cuts, i)), "\n").alias("text")))

    rows = docs.join(own, ["kd", "th"], "left").join(gone, ["kd", "th"], "left").select(
        "row", _let(F.split(F.col("row")[text_col], "\n"), outcome).alias("out"))
    return rows.select("row", F.coalesce("out.n_lines", F.lit(0)).alias("n_lines"), F.coalesce("out.n_removed", F.lit(0)).alias("n_removed"),
                       F.when(F.col("row")[text_col].isNotNull(), F.col("out.text")).alias("text"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The input's columns with repeated lines gone from the texts. Documents that had lines with
    words and lose them all go; those that never had one stay."""
    rows = dedup(docs, id_col, text_col, **more).where("n_lines = 0 or n_removed < n_lines")
    return rows.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
