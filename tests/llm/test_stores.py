"""What operators store goes with them, and near-copy families keep all their links."""

from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline
from caseloom.llm.common import drop, intermediates, store
from caseloom.llm.jaccard import jaccard_components, shingle_set
from caseloom.sources.scratch import shared_folder


def left(spark):
    """Tables in the shared folder outside the session's own run."""
    root = shared_folder(spark).removeprefix("file:")
    return sorted(
        f"{run}/{name}" for run in os.listdir(root) if run.startswith("scratch-") and "session" not in run
        for name in os.listdir(f"{root}/{run}")
    )


def test_runs_inside_runs(spark):
    before = left(spark)
    with intermediates(spark, "outer") as outer:
        with intermediates(spark, "inner") as inner:
            passing = store(spark, spark.range(3), "passing")
            result = inner.lasting(spark.range(4), "result")
            drop(passing)
        assert result.count() == 4 and len(left(spark)) == len(before) + 1
        outer.close()
    assert left(spark) == before
    with pytest.raises(ZeroDivisionError), intermediates(spark, "failing"):
        store(spark, spark.range(3), "passing")
        1 / 0  # noqa: B018
    assert left(spark) == before


def test_the_pipeline_leaves_its_result_only(spark, folder):
    before = left(spark)
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 50 and {r.doc_id for r in rows.collect()} <= set(range(200))
    new = [name for name in left(spark) if name not in before]
    assert len(new) == 1 and "mixing" in new[0]


def test_a_family_of_near_copies_keeps_its_links(spark):
    """Five hundred copies with edits: many pairs under the threshold, several stars, chains between them."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(90)]
    texts = []
    for i in range(500):
        words = list(base)
        for at in rng.sample(range(90), rng.choice([0, 1, 2, 3, 5, 8])):
            words[at] = f"x{rng.randrange(40)}"
        texts.append(" ".join(words))
    sets = [set(shingle_set(t).tolist()) for t in texts]
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in jaccard_components(spark, docs, chunk=32).collect()}
    assert got == {i: root(i) for i in range(len(texts))}
    assert len(set(got.values())) > 1


def test_copies_with_too_much_of_their_own_are_not_compared(spark, monkeypatch):
    """Sixty texts that share 70% of their shingles, in which no two can link; a pair of them does, by a copy spelt twice."""
    from caseloom.llm import jaccard

    base = [f"b{i}" for i in range(200)]
    texts = [" ".join([*base, *(f"own{i}x{j}" for j in range(85))]) for i in range(60)]
    rows = [*enumerate(texts), (60, texts[0].replace("own0x84", "z")), (60, texts[0].replace("own0x84", "Z"))]
    written = {}

    def counted(spark, df, label):
        table = store(spark, df, label)
        written[label] = max(written.get(label, 0), table.select("c").distinct().count() if "c" in table.columns else 0)
        return table

    monkeypatch.setattr(jaccard, "store", counted)
    got = [(r.doc_id, r.component_id) for r in jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [*((i, i) for i in range(60)), (60, 0), (60, 0)]
    assert written["jac-classes"] == 61 and written["jac-posts"] == 2
