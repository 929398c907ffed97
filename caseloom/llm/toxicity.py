"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language."""

from __future__ import annotations

import itertools
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import intermediates, store

_WORD = re.compile(r"[^\W\d_]+|\d+")
PIECE = 5  # longer words are hashed whole and as all their runs of so many letters, so that inflected and joined forms share buckets
# Frequent function words by language, used to guess the language of a text.
_HINTS = {
    "en": "the of and to in is that for with on this are by it was be from",
    "de": "der die und das ist nicht ein eine den dem mit für auf von zu sich",
    "fr": "le la les des est et en un une que qui dans pour pas sur au",
    "es": "el la los las de que y en un una por con para no se del",
}
_LANGUAGES = (*_HINTS, "other")
_HINT_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(_HINTS.values()):
    for _w in _words.split():
        _HINT_OF.setdefault(_w, []).append(_i)


def guess_language(words: list[str]) -> int:
    """Index of the language whose function words are most frequent; the last index if none is."""
    counts = [0] * len(_HINTS)
    for w in filter(None, map(_HINT_OF.get, words)):
        for i in w:
            counts[i] += 1
    best = max(range(len(counts)), key=lambda i: (counts[i], -i))
    return best if counts[best] else len(_HINTS)


class _Buckets(dict):
    """The buckets of a word: its runs of letters in order, then the whole."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: str) -> tuple[int, ...]:
        pieces = [word[i : i + PIECE] for i in range(len(word) - PIECE + 1)] if len(word) > PIECE else []
        pieces.append(word)
        buckets = tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % self.n for p in pieces)
        if len(self) < 200_000 and len(word) <= 40:
            self[word] = buckets
        return buckets


class ConvText:
    """Hashed word embeddings, filters of several widths, max over positions, one logistic output."""

    def __init__(self, buckets: int = 1 << 15, size: int = 12, widths: tuple[int, ...] = (1, 2, 3), filters: int = 12, seed: int = 7, start: float = 0.01):
        rng = np.random.default_rng(seed)
        self.buckets, self.widths, self.filters = buckets, widths, filters
        self.emb = rng.normal(0, start, (buckets, size)).astype(np.float32)
        self.conv = {w: rng.normal(0, 0.4, (w, size, filters)).astype(np.float32) for w in widths}
        self.bias = {w: np.zeros(filters, np.float32) for w in widths}
        self.out = rng.normal(0, 0.3, len(widths) * filters).astype(np.float32)
        self.off = np.float32(-2)
        self.shift = np.zeros(len(_LANGUAGES))
        self.scale = 1.0

    def encode(self, text: str | None, table: _Buckets) -> tuple[np.ndarray, int]:
        words = _WORD.findall((text or "").lower())
        return np.fromiter(itertools.chain.from_iterable(map(table.__getitem__, words)), np.int32), guess_language(words)

    def pooled(self, ids: np.ndarray, projected: dict) -> tuple[np.ndarray, np.ndarray]:
        """Max of each filter over the whole text, and where it is (-1: nowhere above zero)."""
        values, places = [], []
        for w in self.widths:
            n = len(ids) - w + 1
            if n < 1:
                values.append(np.zeros(self.filters, np.float32))
                places.append(np.full(self.filters, -1))
                continue
            acts = self._acts(ids, w, n, projected)
            at = acts.argmax(0)
            top = acts[at, np.arange(self.filters)] + self.bias[w]
            values.append(np.maximum(top, 0))
            places.append(np.where(top > 0, at, -1))
        return np.concatenate(values), np.concatenate(places)

    def project(self, ids: np.ndarray | None = None) -> dict:
        """Each bucket's vector through each filter; with `ids` only of these buckets, the others are undefined."""
        if ids is None:
            return {w: [self.emb @ self.conv[w][k] for k in range(w)] for w in self.widths}
        used = np.zeros(self.buckets, bool)
        used[ids] = True
        rows = np.flatnonzero(used)
        some = self.emb[rows]
        out = {}
        for w in self.widths:
            out[w] = [np.empty((self.buckets, self.filters), np.float32) for _ in range(w)]
            for k in range(w):
                out[w][k][rows] = some @ self.conv[w][k]
        return out

    def _acts(self, ids: np.ndarray, w: int, n: int, projected: dict) -> np.ndarray:
        acts = projected[w][0].take(ids[:n], axis=0)
        for k in range(1, w):
            acts += projected[w][k].take(ids[k : k + n], axis=0)
        return acts

    def logit(self, ids: np.ndarray, projected: dict) -> float:
        """As from `pooled`, without the places."""
        values = np.zeros((len(self.widths), self.filters), np.float32)
        for i, w in enumerate(self.widths):
            n = len(ids) - w + 1
            if n > 0:
                values[i] = np.maximum(self._acts(ids, w, n, projected).max(0) + self.bias[w], 0)
        return float(values.ravel() @ self.out + self.off)

    def flat(self) -> np.ndarray:
        """All that is fitted, as one array."""
        dense = [self.out, [self.off], *self.conv.values(), *self.bias.values()]
        return np.concatenate([self.emb.ravel(), *[np.ravel(part) for part in dense]]).astype(np.float32)

    def add(self, change: np.ndarray) -> None:
        """Add to all that is fitted, in the order of `flat`."""
        at = 0
        for part in [self.emb, self.out, None, *self.conv.values(), *self.bias.values()]:
            if part is None:
                self.off = np.float32(self.off + change[at])
                at += 1
            else:
                part += change[at : at + part.size].reshape(part.shape)
                at += part.size

    def fit(
        self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = 5, rate: float = 0.05, batch: int = 64, seed: int = 7,
        classes: tuple[int, int] | None = None, sums: dict | None = None,
    ) -> dict:
        """Adagrad on log loss, both classes weighing the same. The error flows through the pooled places.

        `classes` are the rows of class 0 and 1 where `labels` are a part of them; `sums` of an earlier call go on.
        """
        rng = np.random.default_rng(seed)
        zeros, ones = classes or ((labels == 0).sum(), (labels == 1).sum())
        weight = np.where(labels == 1, 0.5 / max(1, ones), 0.5 / max(1, zeros)) * (sum(classes) if classes else len(labels))
        weight = np.minimum(weight, 20)
        if sums is None:
            sums = {"emb": np.full_like(self.emb, 1e-3), "out": np.full_like(self.out, 1e-3)}
            sums |= {("conv", w): np.full_like(self.conv[w], 1e-3) for w in self.widths} | {("bias", w): np.full_like(self.bias[w], 1e-3) for w in self.widths}
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for start in range(0, len(order), batch):
                rows = order[start : start + batch]
                projected = self.project(np.concatenate([texts[r] for r in rows]))
                g_emb, touched = np.zeros_like(self.emb), []
                g_conv = {w: np.zeros_like(self.conv[w]) for w in self.widths}
                g_bias = {w: np.zeros_like(self.bias[w]) for w in self.widths}
                g_out, g_off = np.zeros_like(self.out), 0.0
                for r in rows:
                    ids = texts[r]
                    hidden, places = self.pooled(ids, projected)
                    z = float(hidden @ self.out + self.off)
                    err = np.float32((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[r]) * weight[r] / len(rows))
                    g_out += err * hidden
                    g_off += err
                    for i, w in enumerate(self.widths):
                        span = slice(i * self.filters, (i + 1) * self.filters)
                        live = np.flatnonzero(places[span] >= 0)
                        g = err * self.out[span][live]
                        g_bias[w][live] += g
                        for k in range(w):
                            at = ids[places[span][live] + k]
                            g_conv[w][k][:, live] += (g[:, None] * self.emb[at]).T
                            np.add.at(g_emb, at, g[:, None] * self.conv[w][k][:, live].T)
                            touched.append(at)
                used = np.unique(np.concatenate(touched)) if touched else np.zeros(0, np.int64)
                sums["emb"][used] += g_emb[used] ** 2
                self.emb[used] -= rate * g_emb[used] / np.sqrt(sums["emb"][used])
                for name, mine, g in [("out", self.out, g_out)] + [(("conv", w), self.conv[w], g_conv[w]) for w in self.widths] + [
                    (("bias", w), self.bias[w], g_bias[w]) for w in self.widths
                ]:
                    sums[name] += g * g
                    mine -= rate * g / np.sqrt(sums[name])
                self.off -= np.float32(rate * g_off)
        return sums

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, languages: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Per guessed language, the threshold with the best F1 becomes score 0.5; under 20 positives the
        common one, and 0 where there are under 20 in all. `rows` counts the rows of a logit, label and language."""
        rows = np.ones(len(labels), np.int64) if rows is None else rows
        common = _best_threshold(logits, labels, rows) if (labels * rows).sum() >= 20 else 0.0
        for i in range(len(_LANGUAGES)):
            own = languages == i
            enough = (labels[own] * rows[own]).sum() >= 20
            self.shift[i] = _best_threshold(logits[own], labels[own], rows[own]) if enough else common

    def score(self, ids: np.ndarray, language: int, projected: dict) -> float:
        z = np.clip(self.logit(ids, projected) - self.shift[language], -30, 30)
        return float(1 / (1 + np.exp(-z)))


def _best_threshold(logits: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> float:
    """Middle of the widest tie between logits with the best F1; 0 without both classes."""
    positives, whole = (labels * rows).sum(), rows.sum()
    if positives in (0, whole):
        return 0.0
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum((labels * rows)[order])
    f1 = 2 * hits / (np.cumsum(rows[order]) + positives)
    f1[:-1][logits[order][:-1] == logits[order][1:]] = -1
    at = int(f1.argmax())
    after = logits[order][at + 1] if at + 1 < len(order) else logits[order][at] - 1
    return float((logits[order][at] + after) / 2)


_STORED = np.uint16  # holds any bucket


def _ids(given: bytes) -> np.ndarray:
    return np.frombuffer(given, _STORED).astype(np.int32)


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def train_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> ConvText:
    """Fit on all labelled rows that are not held out; a quarter of them calibrates the thresholds instead.

    At most `sample` rows, smallest hash of the key first, reach the driver, as numbers, and give the model a start.
    If there are more, `_fit_on_all` goes on from there in the tasks. Without labels the model stays as it is made.
    """
    model = ConvText()
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(label).alias("_y"))
    known = known.select(F.col(key).alias("k"), F.col("_y").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("k"), "k").limit(sample)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _Buckets(model.buckets)
        for b in batches:
            coded = [model.encode(t, table) for t in b["t"]]
            part = [zlib.crc32(f"fit-{k}".encode()) % 4 for k in b["k"]]
            yield pd.DataFrame({"k": b["k"], "y": b["y"], "ids": [c[0].astype(_STORED).tobytes() for c in coded], "lang": [c[1] for c in coded], "part": part})

    def encoded(wanted: DataFrame) -> DataFrame:
        found = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(wanted, "k").groupBy("k", "y")
        # A repeated key gives one text, the smallest by hash; tasks fold it before the shuffle.
        found = found.agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t"))["t"].alias("t"))
        return found.mapInPandas(encode, f"k {known.schema['k'].dataType.simpleString()}, y int, ids binary, lang int, part int")

    rows = encoded(F.broadcast(chosen)).toPandas()
    rows = rows.sort_values("k", kind="stable", ignore_index=True)
    if not len(rows):
        return model
    ids = [_ids(b) for b in rows["ids"]]
    y, part = rows["y"].to_numpy(), rows["part"].to_numpy()
    fit, check = np.flatnonzero(part > 0), np.flatnonzero(part == 0)
    sums = model.fit([ids[i] for i in fit], y[fit])
    if known.count() > sample:
        with intermediates(docs.sparkSession, "toxicity"):
            _fit_on_all(model, store(docs.sparkSession, encoded(known), "labelled"), sums)
        return model
    projected = model.project()
    logits = np.array([model.logit(ids[i], projected) for i in check])
    model.calibrate(logits, y[check], rows["lang"].to_numpy()[check])
    return model


BLOCKS = 64  # parts of the fitted numbers, each averaged by one group
STEPS = 1000  # logits are counted in steps of a thousandth


def _fit_on_all(model: ConvText, rows: DataFrame, sums: dict) -> None:
    """Fit once over all rows: each task goes on with the model on its own, then their changes are averaged.

    A number that only some tasks changed, such as the vector of a rare word, is averaged over those. Then the
    thresholds are chosen by counts of all calibrating rows by logit, whose number has a bound. The driver gets the
    averages and these counts.
    """
    context = rows.sparkSession.sparkContext
    mine = rows.where("part > 0")
    found = mine.agg(F.count_if(F.col("y") == 0).alias("zeros"), F.count_if(F.col("y") == 1).alias("ones")).first()
    classes, start = (found["zeros"], found["ones"]), context.broadcast((model, sums))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, past = pickle.loads(pickle.dumps(start.value))
        before, n = own.flat(), 0
        for b in batches:
            b = b.sort_values("k", kind="stable")
            past = own.fit([_ids(i) for i in b["ids"]], b["y"].to_numpy(), epochs=1, classes=classes, sums=past)
            n += len(b)
        if n:
            parts = np.array_split(own.flat() - before, BLOCKS)
            yield pd.DataFrame({"block": range(BLOCKS), "n": n, "change": [p.tobytes() for p in parts]})

    def average(parts: pd.DataFrame) -> pd.DataFrame:
        change = np.zeros(len(parts["change"].iloc[0]) // 4)
        weight = np.zeros(len(change))
        for n, given in sorted(zip(parts["n"], parts["change"])):
            one = np.frombuffer(given, np.float32)
            change += n * one.astype(float)
            weight += n * (one != 0)
        mean = (change / np.maximum(weight, 1)).astype(np.float32)
        return pd.DataFrame({"block": [parts["block"].iloc[0]], "change": [mean.tobytes()]})

    changes = mine.mapInPandas(fit, "block int, n long, change binary").groupBy("block").applyInPandas(average, "block int, change binary").toPandas()
    if len(changes):
        model.add(np.concatenate([np.frombuffer(c, np.float32) for c in changes.sort_values("block")["change"]]))
    shared = context.broadcast(model)

    @F.pandas_udf("long")
    def steps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        projected = own.project()
        for b in batches:
            logits = np.array([own.logit(_ids(i), projected) for i in b], dtype=float)
            yield pd.Series(np.rint(np.clip(logits, -50, 50) * STEPS).astype(np.int64))

    counts = rows.where("part = 0").select("y", "lang", steps("ids").alias("at")).groupBy("at", "y", "lang").agg(F.count("*").alias("n"))
    c = counts.orderBy("at", "y", "lang").toPandas()
    model.calibrate(c["at"].to_numpy() / STEPS, c["y"].to_numpy(), c["lang"].to_numpy(), c["n"].to_numpy())


def score_toxicity(docs: DataFrame, model: ConvText, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of every whole text; null is scored as empty. Only the text enters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        table, projected = _Buckets(own.buckets), own.project()
        for texts in batches:
            yield pd.Series([own.score(*own.encode(t, table), projected) for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.col(text)))
