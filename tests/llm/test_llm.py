"""The training-data operators against brute force, SQL and odd input."""

import glob
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarlake.llm import ann, decontamination, jaccard, lm, mixing, quality, registry, secrets, sharding, substrings, suffixes, toxicity
from bazaarlake.llm import text as tx

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORDS = "the old mill by the river stood still while the rain fell on the quiet town and nobody came to see".split()
ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, label string, size long"


def odd_rows():
    base = " ".join(WORDS)
    texts = {
        1: base,
        2: base,
        3: base + " again",
        4: None,
        5: "",
        6: " \n\t",
        7: "one two",
        8: "ONE two",
        9: "x" * 70_000 + " " + base,
        10: "é" * 60 + base,
        11: base.replace("river", "brook"),
        12: "password=abcdefgh1234 AKIA" + "Z" * 20 + " " + "0af" * 20,
    }
    rows = [(i, t, None if i == 5 else "en", None if i in (4, 9) else f"s{i % 3}", None, 0.5, 1, None, 3) for i, t in texts.items()]
    return [*rows, rows[0], (None, base, "en", "s1", None, 0.5, 1, None, 3)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", ["op2_lm_scoring", "op3_secret_scans", "op7_suffix_dedup", "op8_source_mixing", "op10_ngram_jaccard"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = registry.QUERIES[name](spark, SF_DIR)
    cursor = con.execute(registry.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(repr([row[names.index(c)] for c in df.columns]) for row in cursor.fetchall())
    assert sorted(repr(list(row)) for row in df.collect()) == expected


def jump(key, shards):
    key, at, nxt = key % 2**64, -1, 0
    while nxt < shards:
        at, key = nxt, (key * 2862933555777941757 + 1) % 2**64
        nxt = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


def test_sharding(spark, odd, none):
    rows = registry.op1_sharding(spark, SF_DIR).collect()
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 8), jump(r.doc_id, 9))
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in rows)
    out = sharding.shard_rows(odd, "doc_id", 3).collect()
    assert len(out) == len(odd_rows())
    for s in range(3):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.shard_rows(none, "doc_id", 3).count() == 0


def test_sharding_clashing_names(odd):
    names = ["_hash", "_at", "_j", "_file", "_row", "_before", "row", "file", "place", "key", "hash", "at", "j", "n", "first", "before", "slot", "_metadata"]
    wide = odd.withColumns({n: F.lit(n) for n in names})
    for frame in (wide, wide.withColumn("grown_shard", F.lit("x"))):
        out = sharding.shard_rows(frame, "doc_id", 3)
        assert set(out.columns) == {*wide.columns, "shard", "grown_shard", "slot"}
        rows = out.collect()
        assert len(rows) == len(odd_rows()) and all(r[n] == n for r in rows for n in names if n != "slot")
        for s in range(3):
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_mixing_with_many_sources(odd, monkeypatch):
    """The same mix when the sources are too many to broadcast."""
    few = sorted(map(repr, mixing.mix_documents(odd).collect())), sorted(map(repr, mixing.draw_mix(odd).collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    assert (sorted(map(repr, mixing.mix_documents(odd).collect())), sorted(map(repr, mixing.draw_mix(odd).collect()))) == few


def test_mixing(odd, none):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= len(own) + 1
        assert own[0].target <= 2 * own[0].source_size + 1e-6
    assert sum(own[0].target for own in by.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert mixing.mix_documents(none).count() == 0
    drawn = mixing.draw_mix(odd)
    assert drawn.columns == odd.columns
    assert mixing.draw_mix(none).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query(r"[0-9a-f]+") == []
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert frozenset({"sec", "ecr", "cre", "ret"}) in secrets.trigram_query(secrets.ASSIGN)


def test_secrets_odd(odd, none):
    rows = {(r.doc_id, len(r.found)) for r in secrets.scan(odd).collect()}
    assert (12, 3) in rows and (4, 0) in rows and (1, 0) in rows
    assert secrets.scan(odd).count() == len(odd_rows())
    assert secrets.scan(none).count() == 0


def test_secrets_many_in_one_text(spark):
    """More matches than a part of the sums holds, at its edges and some too short, against the standard regular expressions."""
    texts = {n: " é".join(f"token={'k' * (4 + i % 9)} AKIA{'Z' * (8 + i % 7)}" for i in range(n)) for n in (0, 1, 255, 256, 257, 512, 3000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in secrets.scan(docs).collect():
        expected = []
        for rank, rule in enumerate(secrets.BASE):
            found = re.finditer(rule.pattern, texts[r.doc_id])
            expected += [(m.start(), rank, m.end(), rule.name) for m in found if len(m.group(rule.group)) >= rule.least]
        assert [tuple(f) for f in r.found] == sorted(expected)


def test_suffix_order():
    rng = np.random.default_rng(1)
    for _ in range(400):
        s = rng.integers(1, rng.integers(2, 5), rng.integers(0, 70))
        depth = int(rng.integers(1, 60))
        order = suffixes.suffix_order(s, depth)
        assert sorted(order.tolist()) == list(range(len(s)))
        heads = [s[i : i + depth].tolist() for i in order]
        assert heads == sorted(heads)


def removed(rows, length):
    """Brute force: the bytes of each (id, text) that strings of smaller ids cover."""
    least = {}
    data = [(2**63 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for a in range(len(t) - length + 1):
            s = t[a : a + length]
            least[s] = min(least.get(s, 2**64), i)
    out = []
    for i, t in data:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if least[t[a : a + length]] < i:
                gone[a : a + length] = True
        out.append((i, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_substrings_brute_force(spark, none, hot):
    rng = np.random.default_rng(3)
    passages = ["".join(rng.choice(list("abcd é"), 90)) for _ in range(4)]
    rows = []
    for i in range(60):
        own = "".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 200))))
        p = passages[int(rng.integers(4))]
        cut = int(rng.integers(0, 45))
        rows.append((None if i == 59 else i, None if i == 7 else own + p[cut:] + own[:30]))
    rows += [rows[3], rows[4]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.remove_repeats(df, hot_contexts=hot).withColumn("h", F.sha2("kept", 256)).collect()
    assert sorted((2**63 if r.doc_id is None else r.doc_id, r.h) for r in got) == removed(rows, 50)
    assert substrings.remove_repeats(none).count() == 0


def test_hot_anchors_over_several_buckets(spark, monkeypatch):
    """An anchor is hot for all of its documents or for none, whichever share a slice with another."""
    monkeypatch.setattr(substrings, "BYTES_PER_ANCHOR_BUCKET", 400)
    monkeypatch.setattr(substrings, "CONTEXT_BYTES_PER_BUCKET", 400)
    rng = np.random.default_rng(4)
    passages = ["".join(rng.choice(list("abcdefgh"), 130)) for _ in range(3)]
    rows = []
    for i in range(60):
        own = "".join(rng.choice(list("ijklmnop"), int(rng.integers(0, 90))))
        rows.append((i, own + passages[int(rng.integers(3))][int(rng.integers(0, 60)) :]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    for hot in (4, 8, 12):
        got = substrings.remove_repeats(df, hot_contexts=hot).withColumn("h", F.sha2("kept", 256)).collect()
        assert sorted((r.doc_id, r.h) for r in got) == removed(rows, 50)


def test_contexts_travel_by_pack():
    """A pack of texts of several slices sends one row to a bucket, and one for what it settled itself."""
    rng = np.random.default_rng(5)
    passage = "".join(rng.choice(list("abcdefgh"), 400))
    texts = ["".join(rng.choice(list("ijklmnop"), 4_000)) + passage[k % 200 :] for k in range(1_000)]
    column = pa.array(texts, pa.string())
    lists = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        lists.append(np.unique(substrings.Anchors(raw, np.array([0, len(raw)])).hash >> np.uint64(24)).tobytes())
    names = ["mark", "doc_id", "text", "shared", "hot"]
    ids = np.arange(len(texts))
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), column, pa.array(lists, pa.binary()), pa.array([b""] * len(texts), pa.binary())], names)
    assert column.nbytes > 3 * tx.SLICE_BYTES
    sent = pa.Table.from_batches(list(substrings._contexts(50, 40)(iter([batch])))).to_pandas()
    assert len(sent) <= 41 and set(sent["bucket"]) == set(range(40))
    parts = pd.concat([substrings._resolve(50, 3)(rows) for _, rows in sent.groupby("bucket")])
    assert len(parts) <= 40 * 3
    found = pd.concat([substrings._stretches_of_documents(rows) for _, rows in parts.groupby("group")])
    gone = {m: sum(np.frombuffer(high, np.int64) - np.frombuffer(low, np.int64)) for m, low, high in found.itertuples(index=False)}
    assert len(gone) == len(found) == len(texts) - 1
    # The first text has the whole passage, so each other one loses what it has of it; later ones may share a byte before it.
    assert [gone.get(k, 0) for k in range(200)] == [0, *[400 - k for k in range(1, 200)]]


def test_substrings_odd(odd):
    got = substrings.remove_repeats(odd).withColumn("h", F.sha2("kept", 256)).collect()
    assert sorted((2**63 if r.doc_id is None else r.doc_id, r.h) for r in got) == removed([r[:2] for r in odd_rows()], 50)


def test_jaccard_odd(odd, none):
    rows = sorted(jaccard.jaccard_join(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    comp = {r.doc_id: r.component_id for r in rows}
    assert comp[1] == comp[2] == comp[3] == comp[None] == 1
    assert comp[4] == 4 and comp[5] == 5 and comp[8] == 7
    assert {r.doc_id: r.n_shingles for r in rows}[4] == 0
    assert len(rows) == len(odd_rows())
    kept = sorted(r.doc_id for r in jaccard.keep_one(odd).collect())
    assert kept.count(1) == 1 and 2 not in kept and 4 in kept and 8 not in kept
    assert jaccard.keep_one(odd).columns == odd.columns
    assert jaccard.jaccard_join(none).count() == 0


def test_text_map_loses_nothing(spark):
    edges = [0, 1, -1, jaccard.MAP_BITS - 1, jaccard.MAP_BITS, 32767, 32768, 32769, 1 << 40, -(1 << 40)]
    keys = spark.createDataFrame([(k,) for k in edges], "k long")
    texts = spark.createDataFrame([(k, k % 3) for k in edges] + [(n, 0) for n in range(100, 200)], "mark long, text long")
    held = [r.mark for r in jaccard._marked(texts, "mark", keys, "k").collect()]
    # No other mark here has a bit of a key, so the map is exact.
    assert sorted(held) == sorted(edges)
    assert jaccard._marked(texts, "mark", keys.where("k IS NULL"), "k").count() == 0


def test_count_tree_finds_all():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 9, (300, jaccard.GROUPS))
    points[150:] = points[:150] + rng.integers(0, 2, (150, jaccard.GROUPS))
    size = points.sum(axis=1)
    tree = jaccard.CountTree(points, size)
    for i in range(0, 300, 17):
        both = np.minimum(points, points[i]).sum(axis=1)
        must = np.flatnonzero((100 * both >= 75 * (size + size[i] - both)))
        assert set(must) <= set(tree.search(points[i], int(size[i])))


def test_decontamination(spark, documents, odd, none):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    expected = {r.doc_id for r in documents.collect() if any(t in r.text for _, t in items)}
    got = {r.doc_id for r in decontamination.decontamination(documents, benchmark).where("contaminated = 1").collect()}
    assert expected <= got
    clean = decontamination.drop_contaminated(documents, benchmark)
    assert clean.columns == documents.columns
    assert clean.count() == documents.count() - len(got)
    mine = spark.createDataFrame([(1, " ".join(WORDS).upper()), (2, None), (3, ""), (None, "x")], "item_id long, text string")
    found = {r.doc_id: r.item_ids for r in decontamination.decontamination(odd, mine).collect()}
    assert found[1] == [1] and found[3] == [1] and found[9] == [1] and found[4] == [] and found[7] == []
    assert decontamination.decontamination(none, mine).count() == 0
    assert decontamination.decontamination(odd, mine.limit(0)).where("contaminated = 1").count() == 0


def best_windows(text, items):
    """Brute force: items of which an item-sized window of the text holds 0.75 of the weight, with the most it holds."""

    def shingles(t):
        words = t.split()
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)] * bool(words)

    held = {i: shingles(t) for i, t in items}
    weight = {s: 1 / sum(s in own for own in held.values()) for own in held.values() for s in own}
    mine, out = shingles(text), {}
    for i, own in held.items():
        total = sum(weight[s] for s in set(own))
        windows = [set(mine[a : a + len(own)]) for a in range(max(1, len(mine) - len(own) + 1))]
        best = max(sum(weight[s] for s in w & set(own)) for w in windows) / total
        if best >= 0.75 - 1e-9:
            out[i] = round(best, 6)
    return out


@pytest.mark.parametrize("step", [1 << 20, 50])
def test_decontamination_brute_force(step, monkeypatch):
    """Edited and reordered items, items that share most shingles, repeated shingles; every item-sized window counts."""
    monkeypatch.setattr(decontamination, "HITS_PER_STEP", step)
    rng = np.random.default_rng(6)
    some = lambda n, kind="w": [f"{kind}{x}" for x in rng.integers(0, 5000, n)]
    items = []
    for family, k in enumerate((1, 2, 3, 5, 1, 3)):
        base = some(int(rng.integers(40, 90)))
        for j in range(k):
            own = [*base]
            own[5 + j] = f"only{j}"
            items.append((10 * family + j, " ".join(own)))
    items += [(90, "a b c d e " * 8), (91, "two words")]
    texts = ["two words", "a b c d e " * 3, "", "b c d e a b c d e a b"]
    for _, text in items[:-2]:
        words = text.split()
        half = len(words) // 2
        texts.append(" ".join(some(30, "x") + words[half:] + words[:half] + some(30, "x")))
        for edits in range(5):
            own = [*words]
            for at in rng.integers(0, len(own), edits):
                own[at] = "edit"
            texts.append(" ".join(some(20, "x") + own[: len(own) - edits] + some(20, "x")))
    held = decontamination.Benchmark.of([i for i, _ in items], [t for _, t in items])
    own, count = np.unique(np.concatenate([np.unique(held.value[a : a + n]) for a, n in zip(held.first, held.count, strict=True)]), return_counts=True)
    held = held.weigh(dict(zip(own.tolist(), count.tolist(), strict=True)))
    data = [t.encode() for t in texts]
    doc, item, share = held.match(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    got = [{} for _ in texts]
    for d, i, s in zip(doc, item, share, strict=True):
        got[d][items[i][0]] = round(s, 6)
    expected = [best_windows(t, items) for t in texts]
    assert got == expected and sum(map(len, expected)) > 80


@pytest.mark.parametrize("votes, windows", [(1 << 12, 1 << 9), (7, 3)])
def test_fingerprints_find_windows(votes, windows, monkeypatch):
    """The search by fingerprints against the sliding sum over all pairs: edited, reordered, cut, repeated and related items."""
    monkeypatch.setattr(decontamination, "VOTES_PER_STEP", votes)
    monkeypatch.setattr(decontamination, "WINDOWS_PER_STEP", windows)
    rng = np.random.default_rng(9)
    some = lambda n, kind="w": [f"{kind}{x}" for x in rng.integers(0, 5000, n)]
    items, texts = [], ["", "w1 w2", "two words", "a b c d e " * 9, "two words " * 30]
    for family in range(24):
        base = some(int(rng.integers(15, 90)))
        for j in range(1 + family % 4):
            own = [*base]
            own[5 + j] = f"only{j}"
            items.append(own)
    for own in items:
        half = len(own) // 2
        texts.append(" ".join(some(25, "x") + own + some(25, "x")))
        texts.append(" ".join(own + own[::-1] + own))
        texts.append(" ".join(some(25, "x") + own[half:] + own[:half] + items[0]))
        for edits in (1, 2, 3):
            new = [*own]
            for at in rng.integers(0, len(own), edits):
                new[at] = "edit"
            texts.append(" ".join(some(9, "x") + new[edits:] + some(9, "x")))
    items = [" ".join(i) for i in items] + ["two words", "a b c d e " * 6, "..."]
    held = decontamination.Benchmark.of(list(range(len(items))), items)
    value, count = np.unique(np.concatenate([np.unique(held.value[a : a + n]) for a, n in zip(held.first, held.count, strict=True)]), return_counts=True)
    held = held.weigh(dict(zip(value.tolist(), count.tolist(), strict=True)))
    data = [t.encode() for t in texts]
    whole = (np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    every, got = (set(zip(*(x.tolist() for x in f(*whole)), strict=True)) for f in (held.match, held.search))
    assert got <= every and len(every) > 250
    assert len(got) >= 0.95 * len(every)
    assert {d for d, *_ in got} == {d for d, *_ in every}
    whole_items = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items[:-3]) if f" {item} " in f" {t} "}
    assert whole_items <= {(d, i) for d, i, _ in got}


def test_grammar_reads_clauses():
    read = lambda kinds: [r for r, _ in toxicity.Grammar.read(kinds, [1.0] * len(kinds))]
    I, T, Y, N, R, o = toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.OTHER  # noqa: E741
    assert read([Y, o, I]) == [0] and read([o, I]) == [1] and read([N, o, I]) == [2]
    assert read([R, o, o, o, o, o, I]) == [3] and read([T, o, Y]) == [4] and read([T, o]) == []
    assert read([N, o, o, o, o, I]) == [1]


@pytest.mark.parametrize("name, label", [("op5_toxicity", "toxic"), ("op9_quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.1")
    scored = registry.QUERIES[name](spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = scored.select("predicted", label).collect()
    assert np.mean([r.predicted == r[label] for r in rows]) > 0.95


def test_classifiers_odd(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(1, 13)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for run in (toxicity.toxicity, quality.quality):
        rows = run(odd, labels).collect()
        assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
        assert run(odd, labels.limit(0)).count() == len(odd_rows())
        assert run(none, labels).count() == 0
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 8)).astype(np.float32)
    v[100:200] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] * 8), (1150, [None] * 8), (None, v[0].tolist()), (1200, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 400, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        hit += len(set(got[q]) & set(np.lexsort((np.arange(400), -s))[:5].tolist()))
    assert hit >= 0.9 * 40
    assert got[0] == [100, 101, 102, 103, 104] and 1200 not in got
    assert ann.nearest(df.limit(0)).count() == 0


def test_lm_odd(odd, none):
    rows = {r.doc_id: r for r in lm.backoff_scores(odd).collect()}
    assert rows[4].n_words == 0 and rows[4].score is None and rows[1].score == rows[2].score
    assert lm.backoff_scores(odd).count() == len(odd_rows())
    assert lm.backoff_scores(none).count() == 0


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.store(stage(spark, docs, SF_DIR), name)
        if name != "sharding":
            assert docs.columns == documents.columns
        if name in ("toxicity", "ngram_jaccard", "decontamination"):
            assert docs.count() <= before.count()
    texts = {r.doc_id for r in docs.collect()}
    held = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert texts and not any(t in r.text for r in docs.collect() for t in held)
