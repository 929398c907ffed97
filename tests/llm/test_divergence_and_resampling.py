"""Source divergence and importance resampling against plain recomputation and SQL, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm import oracle, queries
from caseloom.llm.divergence import audit_sources, skyband, source_distances
from caseloom.llm.resampling import kth_smallest, resample


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_query_equals_sql(spark, folder, name):
    assert differences(queries.registered()[name](spark, folder), connect(folder), oracle.sql()[name]) == []


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- divergence ------------------------------------------------------------------------------------


def plain_audit(rows, least, top):
    words = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for la, so, t in rows]
    out = []
    for lang in {la for la, _, _ in words}:
        mine = [(so, w) for la, so, w in words if la == lang]
        docs = Counter(t for _, w in mine for t in set(w))
        kept = {t for t, n in docs.items() if n >= least}
        counts = {so: Counter() for so, _ in mine}
        for so, w in mine:
            counts[so].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {so: shares(c) for so, c in counts.items()}, shares(whole)
        for so in counts:
            pairs = [(sum(abs(p[so][t] - p[x][t]) for t in kept), x) for x in counts if x != so]
            terms = [(p[so][t] - q[t], t) for t in kept if counts[so][t] and p[so][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, so, part, x, v, i) for i, (v, x) in enumerate(items, 1) if part == "pair" or i <= top]
    return sorted(out)


def audit_rows():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{a}{b}" for a in "aeéÄß" for b in "xyzXY"] + ["字", "Żółć"]
    rows = [(None, None, None), ("de", "empty", ""), ("de", "empty", "12 34"), ("", "b", "Alpha " * 5000), ("xx", "lone", "once")]
    for i in range(240):
        words = rng.choice(vocabulary, int(rng.integers(1, 30)), p=np.arange(27, 0, -1) / 378)
        rows.append((("en", "de", None)[i % 3], "hot" if i % 2 else f"s{i % 7}", " ".join(words)))
    return rows + rows[-30:]


@pytest.mark.parametrize("top", [3, 50])
def test_audit_equals_plain_recomputation(spark, top):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, p int")
    got = audit_sources(spark, docs.repartition(7), least_docs=5, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 5, top)
    assert audit_sources(spark, docs.limit(0)).collect() == []


def test_blocks_of_sources_give_the_same_distances(spark):
    rng = np.random.default_rng(6)
    groups = [("l", f"s{i:02}", 30, int(rng.integers(1, 50))) for i in range(11)]
    rows = [("l", s, f"t{t}", int(rng.integers(50, 900))) for _, s, _, _ in groups for t in range(30) if rng.random() < 0.4]
    g = spark.createDataFrame(groups, "lang string, source string, v long, p0 long")
    r = spark.createDataFrame(rows, "lang string, source string, term string, p long")
    p = {(s, t): v for _, s, t, v in rows}
    zero = {s: z for _, s, _, z in groups}
    for block in (3, 128):
        got = {(x.source, x.item): x.value for x in source_distances(r, g, block).collect()}
        assert got == {
            (a, b): sum(abs(p.get((a, f"t{t}"), zero[a]) - p.get((b, f"t{t}"), zero[b])) for t in range(30))
            for a in zero for b in zero if a != b
        }


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=40), st.integers(1, 4))
def test_skyband_keeps_what_fewer_than_k_dominate(points, k):
    n, m = (np.array([p[i] for p in points], np.int64) for i in (0, 1))
    terms = np.array([f"t{(i * 7) % 41:02}" for i in range(len(points))], object)
    expected = {
        i for i in range(len(points))
        if sum(n[j] >= n[i] and m[j] <= m[i] and terms[j] < terms[i] for j in range(len(points))) < k
    }
    assert set(skyband(n, m, terms, k)) == expected


# --- resampling ------------------------------------------------------------------------------------


def plain_resample(rows, target, least, percent, longest=1):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]

    split = [(k, *features(t)) for k, t in rows]
    s, t = Counter(b for *_, bs in split for b in bs), Counter(b for x in target for b in features(x)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (t_all := sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000))))
        for b in s
    }
    assert t_all
    out = []
    for k, n_words, bs in split:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    eligible = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: len(eligible) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def draw_rows():
    rng = np.random.default_rng(9)
    words = ["Alpha", "beta", "Gamma", "étude", "42", "x", "字"]
    texts = [None, "", "  ... ", "long " * 20_000] + [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(150)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "beta " * 30)]


@pytest.mark.parametrize("longest", [1, 3])
def test_resample_equals_plain_recomputation(spark, longest):
    rows, target = draw_rows(), ["alpha alpha étude", None, "", "BETA gamma"]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score int, row string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(spark, docs, aim, percent=35, longest=longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(rows, target, 20, 35, longest)


def test_ties_repeats_and_empty_tables(spark):
    """Forty equal rows of one id, all eligible: the draw takes exactly its number of them."""
    aim = spark.createDataFrame([("alpha",)], "text string")
    docs = spark.createDataFrame([(7, "alpha " * 20)] * 40 + [(8, "few words")], "doc_id long, text string")
    rows = resample(spark, docs, aim).collect()
    assert len(rows) == 41 and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4]
    assert resample(spark, docs.limit(0), aim).collect() == []
    assert len(resample(spark, docs, aim.limit(0)).collect()) == 41


@pytest.mark.parametrize("ways", [2, 16])
def test_kth_smallest_counts_exactly(spark, ways):
    values = [-(10**12), 5, 5, 5, -3, 0, 99, 10**13, 5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        value = sorted(values)[k - 1]
        assert kth_smallest(df, "v", k, ways) == (value, sum(v < value for v in values))
