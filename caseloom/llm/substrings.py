"""Substring dedup: hash normalised lines and word windows, keep the first of each, remove the rest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, mix64, roll, store

SALTS = 32
WORD = re.compile(r"\S+")


class _Hashes(dict):
    """Hashes of words, A-Z lowered; short ones are kept while there are fewer than 500,000."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass").lower())
        if len(word) <= 24 and len(self) < 500_000:
            self[word] = value
        return value


_HASHES = _Hashes()


def units(text: str | None, pattern: re.Pattern, least_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, stop, digest) of each unit with enough words; offsets in code points of the given text."""
    for m in pattern.finditer(text or ""):
        words = m.group().translate(LOWER).split()
        if len(words) >= least_words:
            yield m.start(), m.end(), xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def repeated_units(
    spark: SparkSession,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = r"[^\n]+",
    least_words: int = 5,
) -> DataFrame:
    """One row per repeated unit that goes: key, start, stop, first_key (where the kept one is).

    A unit is a match of `unit`, a line by default. Normalised: A-Z lowered, runs of white space one
    space, trimmed; units of fewer than `least_words` words stay. Of the units with one 128-bit digest the
    one with the smallest key, then the smallest start, stays; the others go, also inside one document.
    Null texts have no units; null keys rank last. Rows that repeat a key and a text are one document. Extra columns
    are ignored; an empty table gives no rows.

    The first of each digest is a map-side minimum. Only repeated digests are joined back, with a salt, so
    that a line in a third of all documents is spread over many tasks.
    """
    pattern = re.compile(unit)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *u) for k, t in zip(b["k"].astype("Int64"), b["t"]) for u in units(t, pattern, least_words)]
            yield pd.DataFrame(rows, columns=["k", "start", "stop", "digest"]).astype({"k": "Int64"})

    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    rows = store(spark, given.mapInPandas(split, "k long, start int, stop int, digest binary"), "sub-units")
    found = _later(spark, rows)
    return found.select(F.col("k").alias(key), "start", "stop", F.col("first.k").alias("first_key")).distinct()


def _later(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows (k, start, digest, ...) that are not the first of their digest, with the first's place."""
    # Nulls sort before all others in a struct; the flag puts them last.
    place = F.struct(F.col("k").isNull().alias("last"), "k", "start")
    firsts = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = store(spark, firsts.select("digest", "first"), "sub-firsts")
    spread = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("k", "start"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["digest", "salt"]).where(~(F.col("k").eqNullSafe(F.col("first.k")) & (F.col("start") == F.col("first.start"))))


def windows(text: str | None, size: int, every: int, distinct: int) -> Iterator[tuple[int, int, int, int]]:
    """(place, start, stop, digest) of chosen runs of `size` words, in order.

    Of each `every` runs in a row the one of least hash is chosen (the last among equals), so two texts
    that share size + every - 1 words choose a shared run, wherever it stands and whatever is around it,
    and neighbours are at most `every` words apart. Runs of fewer than `distinct` different words are left out.
    """
    words = WORD.findall(text or "")
    if len(words) < size:
        return
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    digests = roll(ids, size)
    order = mix64(digests)
    if len(order) <= every:
        chosen = np.array([len(order) - 1 - int(np.argmin(order[::-1]))])
    else:
        spans = np.lib.stride_tricks.sliding_window_view(order, every)
        chosen = np.unique(np.arange(len(spans)) + every - 1 - np.argmin(spans[:, ::-1], axis=1))
    runs = np.sort(np.lib.stride_tricks.sliding_window_view(ids, size)[chosen], axis=1)
    chosen = chosen[1 + np.count_nonzero(np.diff(runs, axis=1), axis=1) >= distinct]
    if not len(chosen):
        return
    places = [m.span() for m in WORD.finditer(text)]
    for i in chosen.tolist():
        yield i, places[i][0], places[i + size - 1][1], int(digests[i].astype(np.int64))


def repeated_spans(
    spark: SparkSession,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = 50,
    size: int = 12,
    every: int = 14,
    distinct: int = 6,
) -> DataFrame:
    """One row per span that stands in an earlier document: key, start, stop, n_words.

    The units are runs of `size` words chosen by their own hash (`windows`), so they do not depend on
    line breaks or on the words around a passage. A unit that also stands in a document of a smaller key
    goes; units that go and overlap or follow within `every` words are one span. Any passage of
    `least_words` words shared with an earlier document, with `distinct` different words in each run of
    `size`, gives a span: of its words, all but at most every - 1 at either end are covered, so a span is
    reported from least_words - 2 * (every - 1) words on. Shorter repeats are left alone. Offsets are code
    points of the given text; the words at a passage's ends that the span misses stay in the text.

    Normalised like lines: A-Z lowered, white space between words is the same. Null and short texts have
    no units. Null keys rank last and, like rows that repeat a key and a text, are one document for this
    purpose. Extra columns are ignored; an empty table gives no rows. A very long text is hashed whole.
    Stored and shuffled is one row of four numbers for about every 2 / (every + 1)-th word.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *u) for k, t in zip(b["k"].astype("Int64"), b["t"]) for u in windows(t, size, every, distinct)]
            yield pd.DataFrame(rows, columns=["k", "place", "start", "stop", "digest"]).astype({"k": "Int64"})

    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    rows = store(spark, given.mapInPandas(split, "k long, place int, start int, stop int, digest long"), "sub-windows")
    later = _later(spark, rows).where(~F.col("k").eqNullSafe(F.col("first.k"))).select("k", "place", "start", "stop").distinct()
    order = Window.partitionBy("k").orderBy("place", "start")
    apart = F.col("place") - F.lag("place").over(order) > every
    numbered = later.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = numbered.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = spans.groupBy("k", "span").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max("place") - F.min("place") + size).alias("n_words")
    )
    least = max(size, least_words - 2 * (every - 1))
    return joined.where(F.col("n_words") >= least).select(F.col("k").alias(key), "start", "stop", "n_words")


def _union_of(spans: Column) -> Column:
    """Sorted disjoint spans from overlapping ones."""

    def grow(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        meets = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["stop"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(span)))

    empty = F.array().cast("array<struct<start:int,stop:int>>")
    return F.aggregate(F.array_sort(spans), empty, grow)


def removed_spans(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 50
) -> DataFrame:
    """key and spans (disjoint, in order): whole repeated lines of `least_words` words, and repeated spans."""
    lines = repeated_units(spark, docs, key, text, least_words=least_words).select(key, "start", "stop")
    spans = repeated_spans(spark, docs, key, text, least_words).select(key, "start", "stop")
    both = lines.unionByName(spans).groupBy(key).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return both.select(key, _union_of(F.col("spans")).alias("spans"))


def without_repeats(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """The documents with `text` shortened by the spans that go; all columns and rows stay.

    A document whose whole text goes has an empty text. Nulls stay null.
    """
    spans = removed_spans(spark, docs, key, text, least_words).select(F.col(key).alias("_dedup_key"), F.col("spans").alias("_dedup_spans"))
    spans = store(spark, spans, "sub-spans")
    given = F.col(f"`{text}`")
    # What stands before each span from the end of the one before, and after the last.
    ends = F.concat(F.array(F.lit(0)), F.transform("_dedup_spans", lambda s: s["stop"]))
    starts = F.concat(F.transform("_dedup_spans", lambda s: s["start"]), F.array(F.char_length(given)))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(given, a + 1, b - a))
    joined = docs.join(spans, F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_dedup_key")), "left")
    return joined.withColumn(text, F.when(F.col("_dedup_spans").isNull(), given).otherwise(F.array_join(kept, ""))).drop("_dedup_key", "_dedup_spans")


def dedup_report(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """Per document with removed spans: key, n_removed, chars_removed, removed (start:stop, comma-joined)."""
    spans = F.col("spans")
    return removed_spans(spark, docs, key, text, least_words).select(
        key,
        F.size(spans).cast("long").alias("n_removed"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"])).alias("chars_removed"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("removed"),
    )
