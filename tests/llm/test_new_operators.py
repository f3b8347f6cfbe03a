"""Filter audit, embedding whitening and embedding near-dedup against SQL, brute force and odd input."""

import glob
import itertools
import math
import os
import re

import duckdb
import numpy as np
import pytest

from bazaarlake.llm import audit, neardup, registry, whitening
from bazaarlake.llm.components import components

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, mark binary, good boolean"
LABELS = "doc_id long, quality int, toxic int, good string, part string"
VECTORS = "vec_id long, embedding array<float>, label int, x string, h0 long, node string, component int"


# --- filter audit -----------------------------------------------------------------------------------


def test_audit_matches_sql(spark):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = registry.QUERIES["op11_filter_audit"](spark, SF_DIR)
    cursor = con.execute(registry.ORACLE["op11_filter_audit"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(repr([row[names.index(c)] for c in df.columns]) for row in cursor.fetchall())
    assert sorted(repr(list(row)) for row in df.collect()) == expected


def brute_audit(docs, labels):
    """Every order applied document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        fails.append(
            (
                lang or "",
                {
                    c
                    for c, failed in zip(
                        "ABCDE",
                        (
                            len(words) < 200,
                            100 * len(set(words)) < 50 * len(words),
                            100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                            re.search("[#$%&*|]", text),
                            copy,
                        ),
                        strict=True,
                    )
                    if failed
                },
                i in good and i is not None,
                i in toxic and i is not None,
            )
        )
    out = {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(mine)))
            for step, letter in enumerate(order):
                lost = [k for k in left if letter in mine[k][1]]
                left = [k for k in left if letter not in mine[k][1]]
                gone = [k for k in range(len(mine)) if k not in left and k not in lost and letter in mine[k][1]]
                shapley[letter] += len(lost)
                out[part, "".join(order), step + 1] = [
                    len(left), len(lost), len(gone), sum(m[1] == {letter} for m in mine), sum(mine[k][2] for k in lost), sum(mine[k][3] for k in lost)
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def odd_documents():
    long = " ".join(f"w{i}" for i in range(300))
    return [
        (1, long, "en"),
        (2, long, "de"),
        (2, long, "de"),
        (3, None, "en"),
        (4, "", None),
        (5, " \t\n", ""),
        (6, "SHOUT " * 250, "en"),
        (7, long + " 100%", "en"),
        (8, "é" * 50_000 + " A" * 3_000, "en"),
        (None, long, "en"),
        (None, long, "fr"),
        (9, "a b " * 200, "fr"),
        (10, "x " * 199 + "x", "fr"),
        (11, long.upper(), None),
    ]


def test_audit_brute_force(spark):
    docs = odd_documents()
    labels = [(1, 1, None), (1, 0, 1), (2, None, 1), (3, 1, 0), (7, 1, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(i, t, lang, None, 1, "p", 3, None, True) for i, t, lang in docs], DOCS).repartition(3)
    marks = spark.createDataFrame([(*row, "x", "y") for row in labels], LABELS)
    rows = audit.audit_documents(frame, marks).collect()
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert found == brute_audit(docs, labels) and len(rows) == len(found)


def test_audit_empty(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit_documents(none, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None, None, 1, "p", 3, None, True)], DOCS)
    assert audit.audit_documents(one, labels).count() == 600


def test_packed_fields_hold_large_counts():
    n = 2**61
    total = n * audit.packed(3)[0b101, True, False] + (n - 1) * audit.packed(3)[0b111, False, True]
    fields = audit.unpack(total, 3)
    at = audit.orders(3).index((0, 1, 2))
    assert fields[at].tolist() == [[2 * n - 1, 0, 0, n, n - 1], [0, n - 1, 0, 0, 0], [0, 2 * n - 1, 0, 0, 0]]


# --- whitening --------------------------------------------------------------------------------------


def brute_whitening(ids, vectors):
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    n, deviation, whitened, explained = brute_whitening(table["vec_id"], np.stack(table["embedding"]))
    got = registry.QUERIES["op12_embedding_whitening"](spark, SF_DIR).toPandas()
    assert len(got) == 16 * len(table) and (got["n"] == n).all() and (got["identity_error"] < 1e-9).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    signs = np.sign((wide * whitened).sum(axis=0))
    assert np.abs(wide - whitened * signs).max() < 1e-9
    first = got[got["component"] == 1].set_index("vec_id").loc[table["vec_id"]]
    assert (first["deviation"] == deviation).all()
    assert np.allclose(got[got["vec_id"] == table["vec_id"][0]].sort_values("component")["explained"], explained, rtol=1e-9)


def test_whitening_odd(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6)).astype(np.float32)
    rows = [(i, [float(v) for v in base[i]]) for i in range(40)]
    rows += [rows[0], (None, rows[1][1]), (100, rows[2][1])]
    bad = [(200, None), (201, []), (202, [1.0] * 5), (203, [math.nan] + [1.0] * 5), (204, [math.inf] + [1.0] * 5), (205, [None] + [1.0] * 5), (206, [1e30] + [1.0] * 5)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2, "n", 3) for i, v in rows + bad], VECTORS).repartition(4)
    got = whitening.whitened_components(frame).toPandas()
    assert len(got) == 6 * len(rows) and set(got["n"]) == {40} and set(got["component"]) == set(range(1, 7))
    n, deviation, whitened, _ = brute_whitening(None, base)
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted([*deviation, deviation[0], deviation[1], deviation[2]])
    assert (got["identity_error"] < 1e-9).all()


def test_whitening_without_variance(spark):
    none = spark.createDataFrame([], VECTORS)
    assert whitening.whitened_components(none).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "x", 2, "n", 3) for i in range(5)], VECTORS)
    assert whitening.whitened_components(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0], 1, "x", 2, "n", 3) for i in range(5)], VECTORS)
    got = whitening.whitened_components(line).toPandas()
    assert set(got["component"]) == {1} and len(got) == 5 and got["explained"].tolist() == pytest.approx([1.0] * 5)


def test_whitening_exact_beyond_words(spark):
    """Sums of squares beyond 64 bits are null, those within are exact."""
    rows = spark.createDataFrame([(i, [float(i) * 2.0**30, 1.0], 1, "x", 2, "n", 3) for i in range(4)], VECTORS)
    got = whitening.whitened_components(rows).toPandas()
    x = [[64 * i * 2**30 + 10**6, 10**6 + 64] for i in range(4)]
    sums = [sum(v[k] for v in x) for k in range(2)]
    expected = [sum((4 * v[k] - sums[k]) ** 2 for k in range(2)) for v in x]
    assert all(e > 2**63 for e in expected) and got["deviation"].isna().all()


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 40),
        [3, 3, 3, 1, 1, 1 + 1e-9, 1 + 2e-9, 0.5],
        [1, 1 + 1e-7, 1 + 1.1e-7, 1 + 1e-6, 2, 2, 1e-9],
        [1e6, 1e6 * (1 + 1e-13), 1, 1e-3],
        1 + np.arange(64) * 1e-6,
        [0, 0, 1, 2],
        [0, 0, 0],
    ],
)
def test_refined_eigenvectors(values):
    n = len(values)
    turn = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0]
    matrix = (turn * np.asarray(values, float)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    size = max(np.abs(values).max(), 1)
    found, vectors = whitening.eigen(matrix)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 4e-15 * size
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() <= 4e-15
    assert np.abs(matrix @ vectors - vectors * found).max() <= 4e-15 * size


# --- near-dedup of embeddings -----------------------------------------------------------------------


def brute_neardup(ids, vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            return {(int(i), int(row.sum()) - 1, int(c), bool(i == c)) for i, row, c in zip(ids, linked, label, strict=True)}
        label = new


def turned(rng, vector, cosine):
    """A unit vector at ``cosine`` to a unit ``vector``."""
    z = rng.normal(size=vector.shape)
    z -= (z @ vector) * vector
    return cosine * vector + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "n", 3) for i, v in rows], VECTORS).repartition(5)


def found_rows(df):
    return {tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()}


def test_lattice_decoding():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(300, 8)) * 2
    points = neardup.decode(y)
    again = points[:, None] + neardup.shortest()[None]
    assert (((y - points) ** 2).sum(axis=1)[:, None] <= ((y[:, None] - again) ** 2).sum(axis=2) + 1e-12).all()
    assert len(neardup.shortest()) == 240 and np.allclose((neardup.shortest() ** 2).sum(axis=1), 2)
    doubled = points * 2
    assert (doubled == np.rint(doubled)).all() and (points.sum(axis=1) % 2 == 0).all()


def test_neardup_brute_force(spark, monkeypatch):
    """Chains, groups of copies wider than a chunk, balls that overlap: no link is made up, and few at the very threshold are lost."""
    monkeypatch.setattr(neardup, "CHUNK", 40)
    monkeypatch.setattr(neardup, "MEMBERS", 16)
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(400, 48))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    vectors = list(unit)
    vectors += [turned(rng, unit[0], 0.99) for _ in range(150)]
    vectors += [turned(rng, unit[1], c) for c in (0.93, 0.95, 0.96, 0.97) for _ in range(25)]
    chain = unit[2]
    for _ in range(6):
        chain = turned(rng, chain, 0.94)
        vectors.append(chain)
    vectors = np.array(vectors).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(vectors)) * 3]
    got = found_rows(neardup.near_duplicates(frame_of(spark, [(i, [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)])))
    true = {i: (n, c) for i, n, c, _ in brute_neardup(ids, vectors.astype(float))}
    found = {i: (n, c) for i, n, c, _ in got}
    assert set(found) == set(true) and all(found[i][0] <= true[i][0] for i in ids)
    assert {i: c for i, (_, c) in found.items()} == {i: c for i, (_, c) in true.items()}
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(n for n, _ in true.values())
    # Copies of one vector, its own included, lie well within the threshold of each other.
    copies = [ids[0], *ids[400:550]]
    assert [found[i] for i in copies] == [true[i] for i in copies]


def test_neardup_recall_at_the_threshold(spark):
    rng = np.random.default_rng(11)
    unit = rng.normal(size=(1500, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    other = np.array([turned(rng, v, 0.9005) for v in unit])
    rows = [(2 * i + k, [float(x) for x in v[i]]) for i in range(len(unit)) for k, v in enumerate((unit, other))]
    got = neardup.near_duplicates(frame_of(spark, rows)).toPandas().set_index("vec_id")
    exact = np.array([v for _, v in rows], np.float32).astype(float)
    cosine = (exact[::2] * exact[1::2]).sum(axis=1) / np.linalg.norm(exact[::2], axis=1) / np.linalg.norm(exact[1::2], axis=1)
    assert (cosine >= 0.9).all()
    assert (got["n_links"] > 0).mean() >= 0.95


@pytest.mark.parametrize("meetings", [1 << 40, 0.1])
def test_neardup_with_more_blocks(spark, meetings):
    """The same links with the least blocks and with those that many more vectors would get."""
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.limit(60).collect()]
    rng = np.random.default_rng(2)
    for k in range(30):
        v = np.array(rows[k][1])
        rows.append((1000 + k, [float(x) for x in turned(rng, v / np.linalg.norm(v), 0.985) * 3]))
    blocks, _ = neardup.layout(len(rows), meetings)
    assert blocks == (2 if meetings > 1 else 3)
    got = found_rows(neardup.near_duplicates(frame_of(spark, rows), meetings))
    assert got == brute_neardup([i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(float))


def test_neardup_odd(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (5, a), (3, a), (3, a), (9, [2.0, 0.01, 0.0]), (7, b), (1, [0.0, 0.0, 0.0]), (2, None), (4, [math.nan, 1.0, 0.0]), (6, [math.inf, 1.0, 0.0]),
        (8, [None, 1.0, 0.0]), (10, []), (11, [1.0, 0.0]), (12, [0.0, -1.0, -0.0]), (None, a), (13, [1e-30, 1e-32, 0.0]),
    ]
    got = sorted((tuple(r) for r in neardup.near_duplicates(frame_of(spark, rows)).collect()), key=repr)
    linked = {5: 4, 3: 4, 9: 4, 13: 4}
    expected = [(i, linked.get(i, 0), 3 if i in linked else i, i is not None and (i == 3 or i not in linked)) for i, _ in rows]
    assert got == sorted(expected, key=repr)
    assert neardup.near_duplicates(frame_of(spark, [])).count() == 0
    assert neardup.near_duplicates(frame_of(spark, [(1, None), (2, [])])).count() == 2


# --- components -------------------------------------------------------------------------------------


def test_components(spark):
    """Paths, stars, cycles, random graphs, repeated links, loops and no links at all."""
    rng = np.random.default_rng(4)
    path = rng.permutation(60)
    pairs = [(int(a), int(b)) for a, b in zip(path, path[1:], strict=False)]
    pairs += [(100, i) for i in range(101, 140)] + [(300 + i, 300 + (i + 1) % 20) for i in range(20)] + [(500, 500), (501, 502), (501, 502), (502, 501)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(1000, 1200, size=(150, 2))]
    label = {n: n for pair in pairs for n in pair}
    while True:
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()
    assert {r.node: r.label for r in found} == {n: label[n] for n in linked} and len(found) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
