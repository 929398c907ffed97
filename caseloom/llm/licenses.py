"""License scans: templates with optional and replaceable regions, compiled to token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Base phrases and labels of the contract.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Template markup. [[...]] may be left out, {n} stands for up to n words of any kind.
TEMPLATES = {
    "gpl-3.0-notice": "[[this work is]] licensed under the gnu general public license [[version 3 [[0]]]]",
    "apache-2.0-notice": "licensed under the apache license version 2 0 [[the license]]",
    "cc-by-nc-4.0-notice": "licensed under [[a]] cc by nc 4 0",
    "cc-by-4.0-notice": "licensed under [[a]] cc by 4 0",
    "mit-notice": "[[released]] under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of {6} and associated "
    "documentation files {4} to deal in {4} without restriction",
}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(LOWER))


class TokenAutomaton:
    """A template as states over words: each state has word steps, free steps and any-word steps."""

    def __init__(self, template: str):
        tokens = re.findall(r"\[\[|\]\]|\{\d+\}|[^\s\[\]{}]+", template)
        self.steps: list[dict[str, int]] = [{}]
        self.any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        at, opened = 0, []
        for t in tokens:
            if t == "[[":
                opened.append(at)
            elif t == "]]":
                self.free[opened.pop()].append(at)
            elif t[0] == "{":
                start = at
                skipped = []
                for _ in range(int(t[1:-1])):
                    new = self._new()
                    self.any[at].append(new)
                    skipped.append(new)
                    at = new
                for s in (start, *skipped[:-1]):
                    self.free[s].append(at)
            else:
                # A fresh state per word keeps an option that ends here from leaking into the next.
                new = self._new()
                self.steps[at][t] = new
                at = new
        self.accept = at

    def _new(self) -> int:
        self.steps.append({})
        self.any.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def first_words(self) -> set[str]:
        return {w for s in self._close({0}) for w in self.steps[s]}

    def match(self, words: list[str], start: int) -> int:
        """End of the longest accepted run from `start`, or -1."""
        states, end = self._close({0}), -1
        for at in range(start, len(words)):
            new = {self.steps[s][words[at]] for s in states if words[at] in self.steps[s]}
            new.update(n for s in states for n in self.any[s])
            if not new:
                break
            states = self._close(new)
            if self.accept in states:
                end = at + 1
        return end


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are the contract's phrases. A template adds its label where its mandatory words stand
    exactly, with what it leaves open. The score is 1 with a template, 0.5 with base places only, else
    0. Null text is empty. Every row gives a row; extra columns are ignored.
    """
    compiled = {label: TokenAutomaton(t) for label, t in (templates or TEMPLATES).items()}
    starts: dict[str, list[str]] = {}
    for label, a in compiled.items():
        for w in a.first_words():
            starts.setdefault(w, []).append(label)
    phrases: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, label in BASE.items():
        phrases.setdefault(phrase.split()[0], []).append((phrase.split(), label))
    openers = starts.keys() | phrases.keys()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t in zip(b["k"].astype("Int64"), b["t"]):
                words = words_of(t)
                base, labels, places = set(), set(), []
                for at, w in enumerate(words):
                    if w not in openers:
                        continue
                    for phrase, label in phrases.get(w, ()):
                        if words[at : at + len(phrase)] == phrase:
                            base.add(label)
                            places.append(at)
                    labels.update(x for x in starts.get(w, ()) if x not in labels and compiled[x].match(words, at) >= 0)
                first, last = (places[0], places[-1]) if places else (None, None)
                score = 1.0 if labels else 0.5 if base else 0.0
                out.append((k, len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
            names = ["k", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pd.DataFrame(out, columns=names).astype({"k": "Int64", "first_word": "Int64", "last_word": "Int64"})

    schema = "k long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return given.mapInPandas(scan, schema).withColumnRenamed("k", key)
