"""Repeated passages wherever they stand, against a search over all word runs."""

from __future__ import annotations

import random

from caseloom.llm.substrings import dedup_report, removed_spans, repeated_spans, without_repeats

RNG = random.Random(12)
VOCABULARY = [f"w{i}" for i in range(4000)]


def prose(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts], "doc_id long, text string, k string, start int, _spans string")


def broken(words):
    return "".join(w + RNG.choice([" ", " ", " ", "  ", "\n", "\t"]) for w in words)


def longest_shared(words, others):
    """Per text: the length of the longest run of words that an earlier text holds."""
    best = 0
    for other in others:
        at = {}
        for i in range(len(words)):
            for j in range(len(other)):
                if words[i] == other[j]:
                    at[i, j] = at.get((i - 1, j - 1), 0) + 1
                    best = max(best, at[i, j])
    return best


def test_shared_passages_are_found_at_any_place(spark):
    """Passages of 50 to 80 words in other surroundings, cases and line breaks; shorter ones and own prose stay."""
    passages = [prose(n) for n in (50, 55, 80)]
    bodies = [prose(RNG.randrange(20, 90)) for _ in range(30)]
    for i, body in enumerate(bodies):
        if i % 3 == 0:
            at = RNG.randrange(len(body))
            body[at:at] = passages[i // 3 % 3]
        if i % 3 == 1:
            body[5:5] = passages[0][10:31]  # 21 words: left alone
    texts = [(i, broken(b).upper() if i % 2 else broken(b)) for i, b in enumerate(bodies)]
    found = {r.doc_id: r for r in removed_spans(spark, frame(spark, texts)).collect()}
    lower = [t.lower().split() for _, t in texts]
    shared = [longest_shared(w, lower[:i]) for i, w in enumerate(lower)]
    assert {i for i, n in enumerate(shared) if n >= 50} == set(found) == {i for i in range(30) if i % 3 == 0 and i > 6}
    for i, r in found.items():
        passage = " ".join(passages[i // 3 % 3])
        for s in r.spans:
            words = texts[i][1][s.start : s.stop].lower().split()
            assert " ".join(words) in passage and len(words) >= len(passage.split()) - 26


def test_copies_nulls_and_empty_tables(spark):
    text = broken(prose(70))
    texts = [(4, text), (2, text), (2, text), (None, text), (7, None), (8, ""), (9, "of " * 200), (10, "of " * 200)]
    docs = frame(spark, texts)
    rows = sorted((r.doc_id or -1, r.n_words) for r in repeated_spans(spark, docs).collect())
    assert [k for k, _ in rows] == [-1, 4] and all(44 <= n <= 70 for _, n in rows)
    assert dedup_report(spark, docs.limit(0)).collect() == []
    assert dedup_report(spark, docs).columns == ["doc_id", "n_removed", "chars_removed", "removed"]


def test_texts_without_their_repeats(spark):
    line = " ".join(prose(60))
    own = " ".join(prose(15))
    docs = frame(spark, [(1, f"{own}\n{line}"), (2, f"before\n{line}\nafter"), (3, None), (4, own)])
    got = {r.doc_id: r for r in without_repeats(spark, docs).collect()}
    assert got[1].text == f"{own}\n{line}" and got[2].text == "before\n\nafter"
    assert got[3].text is None and got[4].text == own
    assert list(got[2].asDict()) == docs.columns
