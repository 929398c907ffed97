"""Importance resampling towards a target's word distribution: scores by array, cut-off by counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.ordered import number_rows
from caseloom.sources.scratch import Scratch

from .common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LAST = (1 << 63) - 1


def words_of(text: str) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(WORD), F.lit(0))


def feature_buckets(words: Column, longest: int, buckets: int) -> Column:
    """A bucket for each run of 1 to `longest` consecutive words, repeats included."""

    def runs(n: int) -> Column:
        if n == 1:
            return words
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    every = runs(1) if longest == 1 else F.concat(*[runs(n) for n in range(1, longest + 1)])
    return F.transform(every, lambda w: (F.crc32(w) % buckets).cast("int"))


def bucket_counts(features: DataFrame) -> DataFrame:
    """Occurrences per bucket; folded inside each task, so at most one row per task and bucket moves."""
    return features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def bucket_gains(given: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """floor(1000 ln of target share over given share), add-one smoothed, for each bucket.

    One number per bucket reaches the driver: their number is the parameter `buckets`.
    """
    sides = {}
    for name, counts in (("s", given), ("t", target)):
        sides[name] = counts.withColumnRenamed("n", name)
        sides[name.upper()] = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).scalar()
    everything = given.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    n = {name: F.coalesce(F.col(name), F.lit(0)).cast("double") for name in "st"}
    gain = F.floor(
        1000 * F.log((n["t"] + 1) * (sides["S"] + buckets) / ((n["s"] + 1) * (sides["T"] + buckets)))
    )
    rows = everything.join(sides["s"], "bucket", "left").join(sides["t"], "bucket", "left").select("bucket", gain.alias("gain"))
    return rows.agg(F.sort_array(F.collect_list(F.struct("bucket", "gain"))).alias("rows")).select("rows.gain").first()[0]


def kth_smallest(df: DataFrame, column: str, k: int, ways: int = 16) -> tuple[int, int]:
    """The k-th smallest value of a whole-number column, and how many rows are smaller.

    Exact counts at `ways` thresholds in one pass narrow the interval by that factor: a pass reads one
    stored column and returns `ways` numbers, and the number of passes depends on the range alone.
    `df` has k rows or more.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    smaller = 0  # rows under `low`
    while low < high:
        step = max(1, (high - low) // ways)
        points = list(range(low, high, step))
        counts = df.agg(*[F.count_if(F.col(column) <= F.lit(p)).alias(f"c{i}") for i, p in enumerate(points)]).first()
        first = next((i for i, c in enumerate(counts) if c >= k), len(points))
        if first:
            low, smaller = points[first - 1] + 1, counts[first - 1]
        if first < len(points):
            high = points[first]
    return low, smaller


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: str = "2024",
    ways: int = 16,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Draw documents by importance weight without replacement: key, n_features, weight, score, rank.

    A feature is a run of 1 to `longest` words, its bucket the crc32 of its UTF-8 bytes. A bucket's gain
    is the floored 1000 ln of its share in `target` over its share in `docs`; a document's weight is the
    floored mean of its features' gains (0 without any), its score the weight plus Gumbel noise hashed
    from seed and key. Of the N documents with `least_words` words, the floor(percent * N / 100) highest
    scores are drawn, equal scores by smaller key; `rank` counts them from 1 and is null elsewhere.

    Texts are split once; each document's buckets are stored and scored by looking them up in one array.
    The cut-off comes from exact counts over the stored scores, then over the keys tied at it. Only drawn
    rows are sorted, range-partitioned; the sort has no task of a size that one source, key or score
    could set. Everything is a DataFrame function; what reaches the driver is one number per bucket and
    `ways` counts a pass.

    Null text has no words. A null key hashes as the empty string and comes after all others. Rows equal
    in score and key are told apart by their place in the stored table; as many of them are drawn as the
    cut allows. Very long texts are one row like any other. An empty table gives no rows; an empty
    target gives weights all the same. Extra columns are ignored, whatever their names. `key` must be of
    a whole-number type.
    """
    run = scratch or Scratch(spark, "resample")
    words = F.col("words")
    split = docs.select(F.col(f"`{key}`").alias("k"), words_of(text).alias("words"))
    features = run.keep(
        split.select("k", F.size(words).alias("n_words"), feature_buckets(words, longest, buckets).alias("buckets")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "features",
    )
    aim = target.select(words_of(text).alias("words")).select(feature_buckets(words, longest, buckets).alias("buckets"))
    gains = bucket_gains(bucket_counts(features), bucket_counts(aim), buckets)

    # One literal of `buckets` numbers: parsed once, when the plan is optimised.
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b))
    n = F.size("buckets").cast("long")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = (
        features.select("k", "row", "n_words", n.alias("n_features"), total.alias("total"), noise.alias("noise"))
        .withColumn("weight", F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0))
        .select(
            "k",
            "row",
            (F.col("n_words") >= least_words).alias("eligible"),
            "n_features",
            "weight",
            (F.col("weight") + F.col("noise")).alias("score"),
            (-(F.col("weight") + F.col("noise"))).alias("place"),
            F.coalesce(F.col("k").cast("long"), F.lit(LAST)).alias("tie"),
        )
    )
    scores = run.lasting(scored, "scores")
    run.drop(features)

    levels = ["place", "tie", "row"]
    left = scores.where("eligible")
    want = left.count() * percent // 100
    drawn = F.lit(False)
    if want:
        same = F.col("eligible")
        for level in levels:
            value, smaller = kth_smallest(left, level, want, ways)
            drawn = drawn | (same & (F.col(level) < value))
            same, want = same & (F.col(level) == value), want - smaller
            left = left.where(F.col(level) == value)
        drawn = drawn | same
    shown = ["k", "n_features", "weight", "score"]
    ranked = number_rows(scores.where(drawn).select(*shown, *levels), *levels).select(*shown, F.col("rank").cast("long").alias("rank"))
    rest = scores.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank"))
    if scratch is None:
        run.close(all=False)
    return ranked.unionByName(rest).withColumnRenamed("k", key)
