"""Quality rules: counted defects of every text, and a log-likelihood ratio between trusted and raw text.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials over the
buckets are counted: the trusted target (texts labelled good) and the raw corpus (all texts). Both count each
distinct text once: copies share one occurrence, which is in the target if any of them is labelled good, so
that how often a text was copied says nothing against its words. The score of a text is the mean of log(target / raw) over its words and pairs, so that length does not matter; a text is
kept if the counted defects are in bounds and the score reaches a fixed threshold. Only DataFrame functions.

Defined results: NULL and empty texts have no words and fail; a repeated row is judged like the first; a text of
words that neither multinomial knows scores near zero and stays; without labelled texts every score is zero
and the counted rules decide alone. Equal scores are treated alike. Very long texts are counted whole, in one row; empty
tables stay empty. Other columns are kept whatever their names, but for those of the counts and verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import SPACES, sized, written

BUCKETS = 1 << 15
# Occurrences added to a bucket, in target and raw alike: a bucket of little evidence speaks neither way. They are
# a share of the target's mean count in a bucket, so that verdicts do not sharpen with the size of the input; below
# SMOOTHING occurrences no bucket is believed, however small the input.
SMOOTHING, SMOOTHING_SHARE = 10.0, 1 / 8
# Least mean log-likelihood ratio of a text that is kept.
THRESHOLD = -0.1
WINDOW = 8


def _bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row, however often it is used further on."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _pairwise(values: str, distance: int) -> Column:
    """Hash of each value with the one ``distance`` after it, as long as there is one."""
    rest = F.slice(values, distance + 1, F.greatest(F.size(values) - distance, F.lit(0)))
    return F.slice(F.zip_with(values, rest, lambda a, b: F.xxhash64(a, b)), 1, F.size(rest))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the words of the text (``_words``) and its counts.

    ``n_repeat_words`` counts words inside windows of eight words that the text has twice or more.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = _bind(docs, "_words", F.array_remove(F.split(t, SPACES), ""))
    df = _bind(df, "_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = _bind(df, "_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for distance in (1, 2, 4):  # hashes of 2, 4 and 8 words in a row
        df = _bind(df, "_next", _pairwise("_h", distance)).drop("_h").withColumnRenamed("_next", "_h")
    # Window positions in the order of their hashes; a window is repeated if a neighbour in this order is equal.
    ranked = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), ranked)
    same = F.zip_with(ranked, before, lambda x, y: F.struct(x.alias("x"), (x.h == y.h).alias("e")))
    starts = F.array_sort(
        F.flatten(
            F.transform(
                F.array(F.filter(same, lambda s: s.x.isNotNull())),
                lambda all_: F.transform(
                    F.filter(
                        F.zip_with(
                            all_,
                            F.slice(all_, 2, F.size(all_)),
                            lambda s, after: F.struct(
                                s.x.i.alias("i"),
                                (F.coalesce(s.e, F.lit(False)) | F.coalesce(after.e, F.lit(False))).alias("r"),
                            ),
                        ),
                        lambda s: s.r,
                    ),
                    lambda s: s.i,
                ),
            )
        )
    )
    repeated = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), starts).otherwise(F.array().cast("array<int>"))
    df = _bind(df, "_starts", repeated)
    gaps = F.zip_with(
        "_starts",
        F.slice("_starts", 2, F.size("_starts")),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return df.select(
        *[F.col(c) for c in docs.columns],
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap).alias("n_repeat_words"),
    )


def _features(df: DataFrame, words: str) -> DataFrame:
    """A row for each word and each pair of neighbouring words, with its bucket; one empty row without words."""
    pair = F.arrays_zip(F.col(words).alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"))
    keep = [c for c in df.columns if c != words]
    df = df.select(*keep, F.inline_outer(pair).alias("_a", "_b"))
    first = F.when(F.col("_a").isNotNull(), F.pmod(F.xxhash64(F.lower("_a")), F.lit(BUCKETS)))
    second = F.when(F.col("_b").isNotNull(), F.pmod(F.xxhash64(F.lower("_a"), F.lower("_b")), F.lit(BUCKETS)))
    return df.select(*keep, F.explode(F.array(first, second)).alias("_bucket"))


def bucket_weights(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(_bucket, _weight)``: log-likelihood ratio of each bucket, over all distinct texts. ``trusted`` has the ids of the target."""
    ids = sized(written(trusted.select(F.col(key).alias("_id")).filter("_id IS NOT NULL").distinct(), "trusted"))
    rows = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("_digest")
    )
    rows = rows.join(ids, F.col("_key") == F.col("_id"), "left").withColumn("_target", F.col("_id").isNotNull().cast("double"))
    # Texts with copies, counted by their digests; copies are combined before the shuffle.
    copied = rows.groupBy("_digest").agg(F.count("*").alias("_copies"), F.max("_target").alias("_any")).filter("_copies > 1")
    copied = sized(written(copied.withColumnRenamed("_digest", "_same"), "copied-texts"))
    rows = rows.join(copied, F.col("_digest") == F.col("_same"), "left")
    share = F.coalesce(1 / F.col("_copies"), F.lit(1.0))
    words = F.array_remove(F.split(F.coalesce("_text", F.lit("")), SPACES), "")
    rows = rows.select(share.alias("_share"), (share * F.coalesce("_any", "_target")).alias("_target"), "_text")
    rows = _bind(rows, "_words", words)
    counts = (
        _features(rows.select("_share", "_target", "_words"), "_words").filter("_bucket IS NOT NULL")
        .groupBy("_bucket").agg(F.sum("_share").alias("raw"), F.sum("_target").alias("target"))
    )
    counts = written(counts, "buckets")  # at most BUCKETS rows
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not sums.target:
        return counts.select("_bucket", F.lit(0.0).alias("_weight"))
    # The raw multinomial, scaled to the target's size, so that both sides count the same number of words.
    expected = F.col("raw") * F.lit(sums.target / sums.raw)
    smoothing = max(SMOOTHING, SMOOTHING_SHARE * sums.target / BUCKETS)
    ratio = (F.col("target") + smoothing) / (expected + smoothing)
    return counts.select("_bucket", F.log(ratio).alias("_weight"))


def judge(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` without the text, with the counts, ``base_failed``, ``score`` and ``kept``; one row for each row.

    Three passes over the texts: their digests, the counts of the multinomials, and the scores. The texts are not
    shuffled while those with copies are few.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    if clash := {*names, "base_failed", "score", "kept"} & set(docs.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    weights = F.broadcast(bucket_weights(docs, trusted, text, key))
    # The columns of the caller travel as one, so that their names cannot meet those used here.
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("_own"), F.col(text).alias("_text"))
    rows = counted(packed, "_text").drop("_text").withColumn("_row", F.monotonically_increasing_id())
    scored = (
        _features(rows, "_words").join(weights, "_bucket", "left")
        .groupBy("_row", "_own", *names)
        .agg((F.sum("_weight") / F.count("_bucket")).alias("score"))
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    score = F.coalesce("score", F.lit(0.0))
    return scored.select(
        "_own.*", *names, failed.alias("base_failed"), score.alias("score"),
        (~failed & (score >= threshold)).alias("kept"),
    )
