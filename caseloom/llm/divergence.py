"""How a language's sources differ: word shares of each source against the others and against the language."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.sources.scratch import Scratch

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
TERMS_HELD, ROWS_OUT, FRESH, POINTS_HELD = 400_000, 50_000, 4_096, 1_000_000


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Per task: lang, source, term, n occurrences, docs documents; summed over tasks they are the counts."""

    def frames(held: dict) -> Iterator[pd.DataFrame]:
        rows = [(*group, term, v >> 32, v & 0xFFFFFFFF) for group, terms in held.items() for term, v in terms.items()]
        for start in range(0, len(rows), ROWS_OUT):
            yield pd.DataFrame(rows[start : start + ROWS_OUT], columns=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms_in = re.compile(TERM).findall
        held: dict[tuple[str, str], dict[str, int]] = {}
        size = 0
        for b in batches:
            for group_lang, group_source, t in zip(b["lang"], b["source"], b["text"]):
                group = held.setdefault((group_lang, group_source), {})
                size -= len(group)
                # Lower-casing bytes touches A-Z only.
                for term, n in Counter(terms_in(t.encode().lower().decode())).items():
                    group[term] = group.get(term, 0) + (n << 32) + 1
                size += len(group)
                if size > TERMS_HELD:
                    yield from frames(held)
                    held, size = {}, 0
        yield from frames(held)

    given = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    return given.mapInPandas(count, "lang string, source string, term string, n long, docs long")


def scaled_share(n: str, whole: str, kept: str, smooth: int = 5, scale: int = 1_000_000_000) -> Column:
    """1 + floor(scale * (n + smooth) / (whole + smooth * kept)) in whole numbers."""
    above = f"cast({scale} as decimal(10, 0)) * (cast({n} as decimal(20, 0)) + {smooth})"
    below = f"cast({whole} as decimal(20, 0)) + {smooth} * cast({kept} as decimal(15, 0))"
    return F.expr(f"1L + ({above}) div ({below})")


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the points dominated by fewer than `k` others.

    A point dominates another if its group count is no lower, its language count no higher and its term
    earlier. In order of falling n, rising lang_n and term, dominators come first; a point with k
    dominators has k in the skyband already, so counting among those kept is enough.
    """
    word = np.unique(term, return_inverse=True)[1]
    low, early = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    kept = np.empty(len(n), np.int64)
    size = 0
    for i in np.lexsort((word, lang_n, -n)):
        if size >= k and np.count_nonzero((low[:size] <= lang_n[i]) & (early[:size] < word[i])) >= k:
            continue
        low[size], early[size], kept[size] = lang_n[i], word[i], i
        size += 1
    return kept[:size]


def partition_skybands(points: DataFrame, k: int) -> DataFrame:
    """The rows of each partition that are in the skyband of their group there.

    A row that leaves has k rows before it in any order by the value that both counts give, so the first
    k of a group are always among the rows that stay, however the rows are partitioned.
    """
    columns = ["lang", "source", "term", "n", "lang_n", "value"]

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.iloc[np.sort(skyband(frame["n"].to_numpy(), frame["lang_n"].to_numpy(), frame["term"].to_numpy(), k))]

    def stay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], pd.DataFrame] = {}
        fresh: Counter = Counter()
        for b in batches:
            for group, rows in b.groupby(["lang", "source"], sort=False):
                held[group] = pd.concat([held[group], rows]) if group in held else rows
                fresh[group] += len(rows)
                if fresh[group] >= FRESH:
                    held[group], fresh[group] = cut(held[group]), 0
            if sum(map(len, held.values())) > POINTS_HELD:
                yield from map(cut, held.values())
                held, fresh = {}, Counter()
        yield from map(cut, held.values())

    return points.select(*columns).mapInPandas(stay, "lang string, source string, term string, n long, lang_n long, value long")


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top) if top else ranked


def top_terms(points: DataFrame, top: int, salts: int = 16) -> DataFrame:
    """The `top` terms of each group by value, ties to the earlier term.

    Skybands of the partitions, skybands of what comes together by group and a salt of the term, then
    the exact rank; the limit on the rank acts in each task before the last shuffle.
    """
    local = partition_skybands(points, top)
    met = local.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(salts)))
    return _ranked(partition_skybands(met, top).withColumnRenamed("term", "item"), top)


def source_distances(rows: DataFrame, groups: DataFrame, block: int = 128) -> DataFrame:
    """lang, source, item, value: summed share differences of each two sources of a language.

    `rows` has lang, source, term and share p of the terms a source has; `groups` has lang, source, the
    number of kept terms v and the share p0 of a term that the source lacks. Sources are numbered per
    language and dealt into blocks; for each two blocks a task lays the shares of its terms out as two
    matrices of `block` columns at most and adds up the differences, so no pair of rows is ever a row.
    What a term adds over the difference of the two p0 is summed; the p0 difference itself counts once
    per kept term. One partial row per two sources and task moves.
    """
    number = Window.partitionBy("lang").orderBy("source")
    placed = groups.withColumn("place", F.row_number().over(number) - 1).withColumn("block", F.expr(f"place div {block}"))
    last = placed.groupBy("lang").agg(F.max("block").alias("last"))
    zeros = placed.groupBy("lang", "block").agg(F.sort_array(F.collect_list(F.struct("place", "p0"))).alias("z"))
    spread = (
        rows.join(placed.select("lang", "source", "place", "block"), ["lang", "source"])
        .join(last, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .select("lang", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "term", "place", "p")
    )
    per_term = spread.groupBy("lang", "b1", "b2", "term").agg(F.collect_list(F.struct("place", "p")).alias("has"))
    with_zeros = per_term.join(zeros.select("lang", F.col("block").alias("b1"), F.col("z.p0").alias("z1")), ["lang", "b1"]).join(
        zeros.select("lang", F.col("block").alias("b2"), F.col("z.p0").alias("z2")), ["lang", "b2"]
    )

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for (lang, b1, b2), total in sums.items():
                i, j = np.nonzero(np.triu(np.ones(total.shape, bool), 1)) if b1 == b2 else np.indices(total.shape).reshape(2, -1)
                yield pd.DataFrame({"lang": lang, "i": b1 * block + i, "j": b2 * block + j, "more": total[i, j]})

        for b in batches:
            for (lang, b1, b2), part in b.groupby(["lang", "b1", "b2"], sort=False):
                left, right = (np.array(part[z].iloc[0], np.int64) for z in ("z1", "z2"))
                both = np.tile(np.concatenate([left, right]), (len(part), 1))
                for line, has in zip(both, part["has"]):
                    for entry in has:
                        at, p = entry["place"], entry["p"]
                        if at // block == b1:
                            line[at - b1 * block] = p
                        if at // block == b2:
                            line[len(left) + at - b2 * block] = p
                first, second = both[:, : len(left)], both[:, len(left) :]
                total = sums.setdefault((lang, b1, b2), np.zeros((len(left), len(right)), np.int64))
                for i in range(len(left)):
                    total[i] += np.abs(first[:, i : i + 1] - second).sum(axis=0)
                total -= len(part) * np.abs(left[:, None] - right)
            if len(sums) > 64:
                yield from frames()
                sums.clear()
        yield from frames()

    more = with_zeros.mapInPandas(add, "lang string, i long, j long, more long").groupBy("lang", "i", "j").agg(F.sum("more").alias("more"))
    left, right = (placed.select("lang", "v", *[F.col(c).alias(f"{c}_{s}") for c in ("source", "place", "p0")]) for s in "ab")
    pairs = left.join(right.drop("v"), "lang").where("place_a != place_b")
    keyed = pairs.withColumns({"i": F.least("place_a", "place_b").cast("long"), "j": F.greatest("place_a", "place_b").cast("long")})
    value = F.col("v") * F.abs(F.col("p0_a") - F.col("p0_b")) + F.coalesce("more", F.lit(0))
    return keyed.join(more, ["lang", "i", "j"], "left").select(
        "lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), value.cast("long").alias("value")
    )


def audit_sources(
    spark: SparkSession,
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = 30,
    top: int = 50,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Divergence of sources: lang, source, part, item, value, rank.

    Terms are runs of letters, A-Z lower-cased; a language keeps those in `least_docs` of its documents.
    Each group of language and source, and each language, gives each kept term a smoothed share in whole
    numbers. Part `pair` has, per group, every other source of the language with the summed share
    differences over all kept terms; part `term` the `top` kept terms that the group has and that have a
    higher share there than in the language, with the difference. Ranks run from 1 by falling value,
    ties to the earlier item in UTF-8.

    Tasks count whole texts and pass on one row per group and term. One shuffle by language and term
    brings together a term's counts in all sources, its documents and its total. A source with most
    documents is one row per term like any other. Pairs of sources number what the result has.

    Null text, language and source read as ''. A group without terms is there, with shares of absent
    terms; a language without kept terms has pairs of value 0 and no `term` rows. Repeated rows count
    each time, whatever their key. An empty table gives no rows. A very long text is counted whole.
    Extra columns are ignored, whatever their names.
    """
    run = scratch or Scratch(spark, "audit")
    # The grouping keys contain those of the shuffle, so the sums below need no other one.
    counts = (
        term_counts(docs, lang, source, text)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    same = Window.partitionBy("lang", "term")
    kept = (
        counts.withColumns({"lang_n": F.sum("n").over(same), "lang_docs": F.sum("docs").over(same)})
        .where(F.col("lang_docs") >= least_docs)
        .withColumn("first", F.row_number().over(same.orderBy("source")) == 1)
    )
    kept = run.lasting(kept.select("lang", "source", "term", "n", "lang_n", "first"), "terms")
    of_lang = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    none = F.lit(0).cast("long")
    groups = named.join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "total"])
    absent = F.when(F.col("v") > 0, scaled_share("0", "total", "v")).otherwise(none)
    groups = run.lasting(groups.withColumn("p0", absent), "groups")

    rows = kept.join(groups, ["lang", "source"]).withColumns(
        {"p": scaled_share("n", "total", "v"), "q": scaled_share("lang_n", "lang_total", "v")}
    )
    points = rows.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    parts = {
        "pair": _ranked(source_distances(rows.select("lang", "source", "term", "p"), groups)),
        "term": top_terms(points, top),
    }
    wanted = ["lang", "source", "part", "item", "value", "rank"]
    pair, term = (df.withColumn("part", F.lit(part)).select(*wanted) for part, df in parts.items())
    if scratch is None:
        run.close(all=False)
    return pair.unionByName(term)
