"""Stupid-backoff scores against brute force, over many buckets and slices."""

import math
from collections import Counter

import numpy as np
import pytest

from bazaarlake.llm import lm


@pytest.mark.parametrize("share", [1e-5, 0.02, 1.0])
def test_scores_over_many_buckets(spark, monkeypatch, share):
    """Few, some and many frequent words; a bigram that every text holds, copies, repeated rows and a long text."""
    monkeypatch.setattr(lm, "BYTES_PER_BUCKET", 4_000)
    monkeypatch.setattr(lm, "FREQUENT_SHARE", share)
    rng = np.random.default_rng(3)
    weights = 1 / np.arange(1, 901)
    texts = [" ".join(["all", "rights", *[f"W{w}" for w in rng.choice(900, int(rng.integers(0, 60)), p=weights / weights.sum())]]) for _ in range(300)]
    texts += [texts[0], "", None, "one", " ".join(f"w{w}" for w in rng.integers(0, 900, 20_000))]
    rows = [*enumerate(texts), (5, texts[5]), (None, texts[7])]
    words = [(t or "").lower().split() for _, t in rows]
    one, two, first = Counter(), Counter(), Counter()
    for w in words:
        one.update(w)
        two.update(zip(w, w[1:]))
        first.update(w[:-1])
    total = sum(one.values())

    def log_score(w):
        return sum(math.log(two[p] / first[p[0]]) if two[p] >= lm.MIN_COUNT else math.log(lm.BACKOFF * one[p[1]] / total) for p in zip(w, w[1:]))

    expected = sorted((-1 if i is None else i, len(w), log_score(w)) for (i, _), w in zip(rows, words, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.log_score) for r in lm.backoff_scores(docs).collect())
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected], abs=1e-5)
