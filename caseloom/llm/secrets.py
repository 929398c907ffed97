"""Secret scans: fixed patterns, and an automaton inferred from labelled credentials."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The base patterns of the contract.
_ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
# A part of a run begins after one of these and ends before one, or at an end of the run or of a base span.
_CUTS = frozenset("=/.")
LONGEST = 4096  # symbols of an example that are learned; of a longer one the beginning, without an end
SYMBOLS = 250_000  # symbols of all examples together, which bounds the tree at the driver
_CLASSES = {**{c: "d" for c in "0123456789"}, **{c: "x" for c in "abcdef"}, **{chr(c): "l" for c in range(ord("g"), ord("z") + 1)}}
_CLASSES |= {chr(c): "U" for c in range(65, 91)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every base match, end exclusive, by start, then kind as listed."""
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m.group(2)) >= 12:
            found.append((m.start(), m.end(), "assign"))
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            found.append((m.start(), m.end(), "access"))
    for m in _HEX.finditer(text):
        if m.end() - m.start() >= 16:
            found.append((m.start(), m.end(), "hex"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def credential_values(text: str) -> Iterator[str]:
    """The labelled credentials of a text: the values that the base patterns find."""
    for m in _ASSIGN.finditer(text):
        if len(m.group(2)) >= 12:
            yield m.group(2)
    for start, end, kind in base_spans(text):
        if kind != "assign":
            yield text[start:end]


def _symbols(value: str) -> str:
    return "".join(_CLASSES.get(c, c) for c in value)


class FormatAutomaton:
    """Probabilistic automaton: a prefix tree of the examples whose compatible states are merged.

    Two states are compatible when the Hoeffding bound finds no difference between their frequencies
    of ending and of each next symbol, and the same holds for the states these lead to. States are
    tried in breadth-first order of the tree against those already settled.
    """

    def __init__(self, examples: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.stop: list[int] = [0]
        for value in examples:
            at = 0
            for symbol in _symbols(value[:LONGEST]):
                self.count[at][symbol] = self.count[at].get(symbol, 0) + 1
                if symbol not in self.next[at]:
                    self.next[at][symbol] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.stop.append(0)
                at = self.next[at][symbol]
            self.stop[at] += len(value) <= LONGEST
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _total(self, q: int) -> int:
        return self.stop[q] + sum(self.count[q].values())

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        if not n1 or not n2:
            return False
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            n, m = self._total(p), self._total(q)
            if self._differ(self.stop[p], n, self.stop[q], m):
                return False
            for s in {*self.count[p], *self.count[q]}:
                if self._differ(self.count[p].get(s, 0), n, self.count[q].get(s, 0), m):
                    return False
                if s in self.next[p] and s in self.next[q]:
                    pairs.append((self.next[p][s], self.next[q][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            self.stop[p] += self.stop[q]
            for s, n in self.count[q].items():
                self.count[p][s] = self.count[p].get(s, 0) + n
                if s in self.next[p]:
                    pairs.append((self.next[p][s], self.next[q][s]))
                else:
                    self.next[p][s] = self.next[q][s]

    def _merge_all(self) -> None:
        settled, front = [0], [(0, s) for s in sorted(self.next[0])]
        while front:
            parent, symbol = front.pop(0)
            state = self.next[parent].get(symbol)
            if state is None or state in settled:
                continue
            for old in settled:
                if self._compatible(old, state):
                    self.next[parent][symbol] = old
                    self._fold(old, state)
                    front += [(old, s) for s in sorted(self.next[old]) if self.next[old][s] not in settled and (old, s) not in front]
                    break
            else:
                settled.append(state)
                front += [(state, s) for s in sorted(self.next[state])]
        self.states = len(settled)

    def likelihood(self, value: str) -> float:
        """Mean log-probability per symbol, the end included; -inf where the automaton has no path."""
        at, total, symbols = 0, 0.0, _symbols(value)
        for s in symbols:
            n = self._total(at)
            if s not in self.next[at]:
                return -math.inf
            total += math.log(self.count[at][s] / n)
            at = self.next[at][s]
        if not self.stop[at]:
            return -math.inf
        return (total + math.log(self.stop[at] / self._total(at))) / (len(symbols) + 1)


    def parts(self, run: str, least: float, cuts: frozenset[int] = frozenset()) -> list[tuple[int, int]]:
        """Parts of a run between cuts, the whole included, that have 12 characters, a digit, a letter and the likelihood.

        The mean reaches `least` where the sum of log-probability - least does not fall under 0, and what
        follows depends on the state alone: per state, length up to 12 and kinds seen, only the most likely
        part goes on. Of the parts with one end the most likely is given.
        """
        live: dict[tuple[int, int, bool, bool], tuple[float, int]] = {}
        found = []
        for at, c in enumerate(run):
            if at == 0 or run[at - 1] in _CUTS or at in cuts:
                live[0, 0, False, False] = (0.0, at)
            symbol, digit, letter = _CLASSES.get(c, c), c.isdigit(), c.isalpha()
            new: dict[tuple[int, int, bool, bool], tuple[float, int]] = {}
            for (q, n, d, a), (excess, start) in live.items():
                if symbol in self.next[q]:
                    key = (self.next[q][symbol], min(n + 1, 12), d or digit, a or letter)
                    value = (excess + math.log(self.count[q][symbol] / self._total(q)) - least, start)
                    if key not in new or new[key] < value:
                        new[key] = value
            live = new
            if live and (at + 1 == len(run) or run[at + 1] in _CUTS or at + 1 in cuts):
                ends = [
                    (excess + math.log(self.stop[q] / self._total(q)) - least, start)
                    for (q, n, d, a), (excess, start) in live.items()
                    if n == 12 and d and a and self.stop[q]
                ]
                # Sums in another order may round apart from the mean.
                if ends and max(ends)[0] >= -1e-9:
                    found.append((max(ends)[1], at + 1))
        return found


def infer_formats(docs: DataFrame, text: str = "text", examples: int = 3000) -> tuple[FormatAutomaton, float]:
    """Infer the automaton from at most `examples` distinct labelled credentials, smallest hash first.

    Of values over LONGEST symbols the beginning is learned. Values enter up to SYMBOLS symbols in all.
    Returns it with the likelihood that 99% of the examples reach. No credentials: an automaton that
    accepts nothing.
    """

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"value": [v for t in batch["t"] for v in {v[: LONGEST + 1] for v in credential_values(t or "")}]}, dtype=object)

    rows = (
        docs.select(F.col(text).alias("t"))
        .mapInPandas(values, "value string")
        .distinct()
        .orderBy(F.xxhash64("value"), "value")
        .limit(examples)
        .collect()
    )
    total = itertools.accumulate(len(r["value"]) for r in rows)
    learned = [r["value"] for r, n in zip(rows, total) if n <= SYMBOLS]
    automaton = FormatAutomaton(learned)
    scores = sorted(automaton.likelihood(v) for v in learned if len(v) <= LONGEST)
    return automaton, (scores[len(scores) // 100] if scores else math.inf)


def scan_secrets(
    docs: DataFrame, automaton: FormatAutomaton, least: float, text: str = "text", redact: str | None = None
) -> DataFrame:
    """Add `base`, `inferred` (arrays of start, end, kind) and, if asked for, text with each secret replaced.

    A candidate is a run of 12 or more credential characters, and each part of it between '=', '/', '.' and the
    ends of base spans, with 12 characters, a digit and a letter, not inside a base span, at least as
    likely as `least` under the automaton: kind `inferred`. Parts that overlap are one span. Null text is
    empty and stays null when redacted. Offsets are code points.
    """
    spans = "array<struct<start:int,stop:int,kind:string>>"
    result = f"struct<base:{spans},inferred:{spans},redacted:string>"

    @F.pandas_udf(result)
    def scan(texts: pd.Series) -> pd.DataFrame:
        out = []
        for given in texts:
            t = given or ""
            base = base_spans(t)
            more = []
            for m in _CANDIDATE.finditer(t):
                v = m.group()
                if not any(c.isdigit() for c in v) or not any(c.isalpha() for c in v):
                    continue
                first = m.start()
                near = [(s - first, e - first) for s, e, _ in base if s < m.end() and first < e]
                joined: list[list[int]] = []
                for s, e in sorted(p for p in automaton.parts(v, least, frozenset(x for n in near for x in n)) if not any(n[0] <= p[0] and p[1] <= n[1] for n in near)):
                    if joined and s < joined[-1][1]:
                        joined[-1][1] = max(e, joined[-1][1])
                    else:
                        joined.append([s, e])
                more += [(first + s, first + e, "inferred") for s, e in joined]
            hidden = given
            if redact is not None and (base or more):
                parts, at = [], 0
                for s, e, _ in sorted([*base, *more]):
                    if s >= at:
                        parts += [t[at:s], redact]
                    at = max(at, e)
                hidden = "".join([*parts, t[at:]])
            out.append((base, more, hidden if redact is not None else None))
        shape = lambda found: [{"start": s, "stop": e, "kind": k} for s, e, k in found]
        return pd.DataFrame(
            {"base": [shape(b) for b, _, _ in out], "inferred": [shape(m) for _, m, _ in out], "redacted": [r for _, _, r in out]}
        )

    return docs.withColumn("_scan", scan(F.col(text)))


def secret_report(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of base kinds, hash of the base spans, and all spans."""
    automaton, least = infer_formats(docs, text)
    found = scan_secrets(docs.select(F.col(key), F.col(text)), automaton, least, text)
    base = F.col("_scan.base")
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    both = F.array_sort(
        F.transform(
            F.concat(base, F.col("_scan.inferred")),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "inferred")]), s["kind"]).alias("place"),
                s["stop"].alias("stop"),
                s["kind"].alias("kind"),
            ),
        )
    )
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        key,
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform(base, as_text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(both, as_text), ",").alias("spans"),
    )
