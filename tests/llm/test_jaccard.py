"""The n-gram Jaccard join against brute force, over many buckets and parts."""

import numpy as np

from bazaarlake.llm import jaccard


def _corpus(rng):
    """Texts of random words: a hot group of near copies, one passage in many of the rest, chains and short ones."""
    words = [f"w{i}" for i in range(4000)]
    passage, hot = rng.choice(words, 60).tolist(), rng.choice(words, 160).tolist()
    texts = []
    for _ in range(120):
        near = list(hot)
        for at in rng.integers(0, len(hot), 2):
            near[at] = str(rng.choice(words))
        texts.append(near)
    for _ in range(120):
        texts.append([*passage, *rng.choice(words, int(rng.integers(5, 60))).tolist()])
    chain = rng.choice(words, 100).tolist()
    for _ in range(20):
        chain = [*chain[4:], *rng.choice(words, 4).tolist()]
        texts.append(chain)
    texts += [rng.choice(words[:3], int(rng.integers(1, 7))).tolist() for _ in range(60)]
    return [" ".join(t) for t in texts]


def test_jaccard_many_buckets_and_parts(spark, monkeypatch):
    """Brute force over several buckets, parts and slices, with a hot group and a passage that many texts hold."""
    monkeypatch.setattr(jaccard, "TOKENS_PER_BUCKET", 3_000)
    monkeypatch.setattr(jaccard, "HEADS_PER_PART", 200)
    texts = _corpus(np.random.default_rng(11))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(24)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in enumerate(sets)}
    assert 1 < len({c for _, c in got.values()}) < len(texts)


def test_near_but_unlinked_sets_send_few_pairs(spark):
    """Sets that share 68 % meet at many shingles; hardly a pair of them may leave the tree, and all links must."""
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 1 << 63, 170, dtype=np.uint64)
    sets = [np.unique(np.append(shared, rng.integers(0, 1 << 63, 40, dtype=np.uint64))) for _ in range(60)]
    sets += [np.unique(np.append(s[:-1], rng.integers(0, 1 << 63, 1, dtype=np.uint64))) for s in sets[:5]]
    rows = [(i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "cls long, n long, tokens binary").repartition(4)
    named = jaccard._heads(df).selectExpr("token", "cls", "cls as label")
    pairs = {tuple(r) for r in jaccard._candidates(named, jaccard._points(df), 3).collect()}
    assert {(i, 60 + i) for i in range(5)} <= pairs
    assert len(pairs) <= len(sets)
