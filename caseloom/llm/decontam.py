"""Benchmark decontamination: n-gram seeds, then local alignment of words."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import roll

_WORD = re.compile(r"[^\W_]+")
ITEM_BYTES = 16 << 20


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class ItemIndex:
    """Words and n-grams of one block of benchmark items; a block's text is at most ITEM_BYTES.

    N-grams are 64-bit hashes in order; an n-gram's number is its place there.
    """

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n = n
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _words(text)], np.int32)
            self.items.append((item, ids))
        hashes = [roll(ids.astype(np.uint64), n) for _, ids in self.items]
        self.grams = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        # Where each n-gram stands: (place in self.items, first word).
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.grams]
        for number, h in enumerate(hashes):
            for place, gram in enumerate(np.searchsorted(self.grams, h).tolist()):
                self.places[gram].append((number, place))

    def encode(self, text: str | None) -> np.ndarray:
        look = self.vocabulary.get
        return np.array([look(w, 0) for w in _words(text)], np.int32)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of n-grams that some item has. Only runs of known words are hashed."""
        n = self.n
        none = np.zeros(0, np.int32)
        if len(ids) < n or not len(self.grams):
            return none, none
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(known[n:] - known[:-n] == n)
        if not len(at):
            return none, none
        hashes = roll(ids.astype(np.uint64), n)[at]
        number = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
        found = self.grams[number] == hashes
        return at[found].astype(np.int32), number[found].astype(np.int32)


def align(a: np.ndarray, b: np.ndarray, match: int = 2, other: int = -1, gap: int = -1) -> tuple[int, int]:
    """Smith-Waterman: best local score of b in a, and where it ends in a. Rows run over the item b."""
    before = np.zeros(len(a) + 1, np.int64)
    best, end = 0, 0
    steps = np.arange(len(a) + 1) * gap
    for word in b:
        row = np.zeros(len(a) + 1, np.int64)
        row[1:] = np.maximum(before[:-1] + np.where(a == word, match, other), before[1:] + gap)
        row = np.maximum(row, 0)
        # A gap along a: the running maximum of value minus the gaps up to there.
        row = np.maximum(np.maximum.accumulate(row - steps) + steps, 0)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        before = row
    return best, end


def contaminated(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    n: int = 3,
    least: float = 0.5,
    block_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """One row per document and item that it holds a copy of: key, item_id, score, start_word, end_word.

    Every n-gram of an item is a seed, however often documents hold it. Each seed found in a document opens a
    window of the item's length and, on both sides, of as many words as an alignment of score `least` can
    insert; windows that overlap are joined. The score is the best local alignment over its maximum, 2 per
    item word; `least` is needed. Windows that `ceiling` shows to stay under it are not aligned.
    A copy that shares no `n` consecutive words with the item (every n-th word changed, or closer) has no seed
    and is not found, whatever its score; nor are items of fewer than `n` words.

    Null texts are empty. Null keys are reported as such. Items go in blocks of `block_bytes` of text, so
    what is broadcast has a fixed bound however large the benchmark is. Repeated items give a row each.
    """
    spark_items = items.select(F.col(item_key).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = spark_items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total * 2 // block_bytes))
    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    out = None
    for block in range(blocks):
        part = spark_items if blocks == 1 else spark_items.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == block)
        rows = _one_block(spark, given, [(r["i"], r["t"]) for r in part.collect()], n, least)
        out = rows if out is None else out.unionByName(rows)
    return out.select(F.col("k").alias(key), F.col("i").alias(item_key), "score", "start_word", "end_word")


def ceiling(matches: int, hits: int, n: int) -> float:
    """No alignment of at most `matches` matched words and `hits` matched n-grams scores more.

    r runs of matched words have at least r - 1 errors between them and matches - (n - 1) r n-grams.
    """
    most = 2.0 * matches
    return min(most, most - (matches - hits) / (n - 1) + 1) if n > 1 else most


def _one_block(spark: SparkSession, given: DataFrame, items: list, n: int, least: float) -> DataFrame:
    shared = spark.sparkContext.broadcast(ItemIndex(items, n))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for b in batches:
            rows = []
            for k, t in zip(b["k"].astype("Int64"), b["t"]):
                ids = own.encode(t)
                for number, spans in _windows(own, ids, least).items():
                    item, words = own.items[number]
                    need = least * 2 * len(words)
                    best = (0, 0, 0)
                    for lo, hi, hits in spans:
                        part = ids[lo:hi]
                        matches = min(int(np.isin(part, words).sum()), int(np.isin(words, part).sum()))
                        if ceiling(matches, hits, n) >= need:
                            best = max(best, (*align(part, words), lo), key=lambda r: (r[0], -r[2]))
                    score = best[0] / (2 * len(words))
                    if best[0] and score >= least:
                        rows.append((k, item, score, best[2], best[2] + best[1]))
            yield pd.DataFrame(rows, columns=["k", "i", "score", "start_word", "end_word"]).astype({"k": "Int64", "i": "Int64"})

    return given.mapInPandas(search, "k long, i long, score double, start_word long, end_word long")


def _windows(index: ItemIndex, ids: np.ndarray, least: float) -> dict[int, list[list[int]]]:
    """Per item number: windows [first word, end, places with a seed], by first word, apart from each other."""
    opened: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for at, gram in zip(*(x.tolist() for x in index.hits(ids))):
        for number, place in index.places[gram]:
            size = len(index.items[number][1])
            slack = int(2 * size * (1 - least))
            opened[number].append((max(0, at - place - slack), min(len(ids), at - place + size + slack), at))
    out = {}
    for number, spans in opened.items():
        joined: list[list] = []
        for lo, hi, at in sorted(spans):
            if joined and lo <= joined[-1][1]:
                joined[-1][1] = max(hi, joined[-1][1])
                joined[-1][2].add(at)
            else:
                joined.append([lo, hi, {at}])
        out[number] = [[lo, hi, len(places)] for lo, hi, places in joined]
    return out
