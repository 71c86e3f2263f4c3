"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions only.

Words are runs of characters other than x20 and x09-x0D. Two multinomials over
``BUCKETS`` hashed n-grams (one and two words) are counted in one pass: the raw corpus (all documents)
and the trusted target (documents with quality 1; of more than ``SAMPLE`` ids, those with the smallest hashes).
The target is smoothed with ``PRIOR`` n-grams dealt out by the raw shares, so a bucket of which the target
knows nothing has a ratio near 0 and few labels judge mildly. A document's score is the mean log ratio of its
n-grams, in whole millionths per n-gram, so that sums do not depend on their order; documents below
``min_score`` fail, as do those that break a rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.common import Scratch, bounded_sample, prepare

BUCKETS = 1 << 14
PRIOR = float(BUCKETS)
#: Most trusted documents that the target is counted from.
SAMPLE = 20_000
MIN_SCORE = -0.12
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"
_NOT_BLANK = r"[^\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK_RUN), lambda w: w != "")


def _indexes(count: Column) -> Column:
    """0 to count - 1; empty if count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that stand twice or more in the text.

    Windows, as 96 bits of two hashes, are sorted with their places, so equal ones are
    neighbours; the places of repeated ones, in order, each cover as many new words as fit before the next.
    """

    def window(i: Column) -> Column:
        three = [F.get(words, i + j) for j in range(3)]
        return F.struct(F.xxhash64(*three).alias("s"), F.hash(*three).alias("t"), i.alias("i"))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["s"] == b["s"]) & (a["t"] == b["t"]), F.lit(False))

    def covered(places: Column) -> Column:
        following = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
        return F.aggregate(following, F.lit(0).cast("long"), lambda total, n: total + n)

    ordered = F.sort_array(F.transform(_indexes(F.size(words) - 2), window))
    places = let(ordered, lambda a: F.sort_array(F.transform(F.filter(a, lambda x, j: same(x, F.get(a, j - 1)) | same(x, F.get(a, j + 1))), lambda x: x["i"])))
    return let(places, covered)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_NOT_BLANK))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def grams(words: Column) -> Column:
    """Buckets of all words and of all pairs of neighbouring words."""
    pairs = F.transform(_indexes(F.size(words) - 1), lambda i: _bucket(F.get(words, i), F.get(words, i + 1)))
    return F.concat(F.transform(words, lambda w: _bucket(w)), pairs)


def trusted_ids(trusted: DataFrame) -> DataFrame:
    """trusted_id: the distinct ids of ``trusted``, of more than ``SAMPLE`` those with the smallest hashes."""
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null").distinct()
    return bounded_sample(ids, F.xxhash64("trusted_id"), SAMPLE)


def log_ratios(docs: DataFrame, trusted: DataFrame, scratch: Scratch) -> DataFrame:
    """bucket, ratio: the log of target over raw share of each bucket, in millionths.

    Counts are combined before they are shuffled; ``BUCKETS`` rows are left at any size. At most ``SAMPLE`` ids are broadcast, so no text is shuffled.
    """
    ids = F.broadcast(scratch.write(trusted_ids(trusted), "trusted"))
    marked = docs.join(ids, docs["doc_id"] == ids["trusted_id"], "left").select("text", F.col("trusted_id").isNotNull().cast("int").alias("trusted"))
    buckets = marked.select("trusted", F.explode(let(words_of(F.coalesce("text", F.lit(""))), grams)).alias("bucket"))
    counts = scratch.write(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("r"), F.sum("trusted").alias("t")), "counts")
    whole = counts.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    both = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    raw = (F.coalesce("r", F.lit(0)) + 1.0) / F.lit(whole["r"] + float(BUCKETS))
    target = (F.coalesce("t", F.lit(0)) + PRIOR * raw) / F.lit(whole["t"] + PRIOR)
    return scratch.write(both.select("bucket", F.round(F.log(target / raw) * 1_000_000).cast("long").alias("ratio")), "ratios")


def judge(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    A null text has no words and fails. ``score`` is null without n-grams, which counts
    as passing the likelihood test (the rules then decide). Without trusted documents
    all scores are 0. Repeated rows are judged one by one; a repeated label counts
    once. Only doc_id, text and the labels' doc_id and quality are read.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "quality")
    docs = docs.select("doc_id", "text")
    ratios = log_ratios(docs, labels.where("quality = 1"), scratch)
    # BUCKETS numbers at any size of the corpus; the optimizer folds them into one constant array.
    numbers = [str(r["ratio"]) for r in ratios.orderBy("bucket").collect()]
    table = F.split(F.lit(",".join(numbers)), ",").cast("array<bigint>")

    text = F.coalesce("text", F.lit(""))

    def facts(words: Column) -> Column:
        ratio_sum = F.aggregate(grams(words), F.lit(0).cast("long"), lambda total, b: total + F.get(table, b))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).alias("n_repeat_words"),
            ratio_sum.alias("ratio_sum"),
        )

    rows = docs.select(
        "doc_id",
        let(words_of(text), facts).alias("facts"),
        F.length(F.translate(text, _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
    )
    n_words, n_repeat = F.col("facts.n_words"), F.coalesce("facts.n_repeat_words", F.lit(0).cast("long"))
    score = F.col("facts.ratio_sum") / F.when(n_words > 0, 2 * n_words - 1) / 1_000_000
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED_PERCENT * n_words)
    return rows.select(
        "doc_id", n_words.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", n_repeat.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & F.coalesce(score >= min_score, F.lit(True))).alias("kept"), score.alias("score"),
    )
