"""Exact Jaccard join of documents on five-word shingles, through an R-tree of count vectors.

Shingles are hashed to groups; the counts per group make a document a point, and the sum of the coordinate
minima of two points bounds how many shingles the documents share. A tree of boxes over coarse points finds all
points whose bound admits a link, box by box; points of 65,536 groups, which few unlinked pairs pass, are compared
in the same task, and what is left is verified on the shingle sets.

What keeps this from comparing everything with everything:

1. Shingles are counted over the corpus. A document can only link if at least 75 % of its shingles occur in
   some other document, so all others are done. Copies that share a passage, but little else, end here too.
2. Documents of one shingle set are one class with one point.
3. Where classes share their first shingle, each is linked to one of them, if the pair verifies; then so are the
   components that meet at one of a few first shingles, by one class each. This settles most members of large
   groups of near copies in linear work: about one pair a class, of which a link a class stays as a forest.
4. Two classes that link share a shingle among the first quarter of both, in any order common to all. Rare shingles
   come first, so that passages of many documents bring few together. Points meet where they share such a
   shingle and are not yet in one component. There the tree is built and searched.

Links between classes that are in one component already are not looked for again; they can't change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import text as tx
from bazaarlake.llm.components import components
from bazaarlake.llm.storage import store, tasks_for

SHINGLE = 5
NEED, OF = 75, 100
#: Groups of the tree's boxes and of the points, which are written as the sorted groups of their shingles (2 bytes each).
GROUPS, FINE_GROUPS = 64, 65_536
#: First shingles at which classes, and then components, are linked by stars.
STARS = (1, 12)
TOKENS_PER_BUCKET = 2_000_000
HEADS_PER_PART = 50_000
LEAF, FAN = 16, 8
#: Queries that walk a tree together, and points or boxes compared at once.
QUERIES, BOUNDS = 256, 16_384
#: Pairs of a part that are gathered, so that one that meets at many shingles is judged once.
PAIRS = 1_000_000
#: Shingles in at least FEW slices are frequent; about OFTEN of them are known to every task (9 MB).
FEW, OFTEN = 4, 1_000_000
#: Bits of the map that spares most unwanted texts a shuffle: 16 MB, whatever the input.
MAP_BITS = 1 << 27


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and shingles (sorted, distinct), set sizes and set fingerprints of a slice."""
    words = tx.Words(data, offsets)
    rows, _, value = tx.shingles(words, SHINGLE)
    rows, value = tx.distinct(rows, value)
    size = np.bincount(rows, minlength=len(offsets) - 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(value + np.uint64(0x8CB92BA72F3D8DD7)), dtype=np.uint64)])
    end = np.cumsum(size)
    return rows, value, size, tx.mix(total[end] - total[end - size] + size.astype(np.uint64))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``text_key``, ``n_shingles``, ``cls``): size and fingerprint of each document's shingle set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column("text")):
                _, _, size, mark = _sets(data, offsets)
                head = [batch.column(c).slice(low, high - low) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*head, pa.array(size.astype(np.int64)), pa.array(mark.view(np.int64))], ["doc_id", "text_key", "n_shingles", "cls"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, cls long")


def shared_shingles(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(``cls``, ``shared``): how many of a class's shingles occur in another document, or more; and (``often``, ``times``).

    Shingles go to ``buckets`` by hash, packed by slice; what several documents of a slice share is known
    there already and goes on as one entry, so no bucket gets more than an entry per slice of a frequent
    shingle. Entries keep 40 bits of the hash; a chance agreement can only make the number larger.

    ``often`` packs the upper 40 bits of the most frequent shingles of a bucket (`OFTEN` over all, one a bucket at
    least) and ``times`` in how many slices they occur, as powers of two.
    """
    alone = 65535

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column("text")):
                rows, value, size, mark = _sets(data, offsets)
                if not len(value):
                    continue
                # Copies within the slice keep one document, marked as shared as a whole.
                marks, first, copies = np.unique(mark, return_index=True, return_counts=True)
                keep = np.zeros(len(mark), bool)
                keep[first] = True
                mine = keep[rows]
                rows, value = np.searchsorted(marks, mark[rows[mine]]), value[mine]
                order = np.argsort(value, kind="stable")
                rows, value = rows[order], value[order]
                lead = np.ones(len(value), bool)
                lead[1:] = value[1:] != value[:-1]
                at = np.flatnonzero(lead)
                run = np.diff(np.append(at, len(value)))
                several = np.repeat(run > 1, run) | (copies[rows] > 1)
                local = np.bincount(rows[several], minlength=len(marks)).astype(np.int32)
                ref = np.where((run > 1) | (copies[rows[at]] > 1), alone, rows[at]).astype(np.uint16)
                token = value[at]
                bucket = (token % np.uint64(buckets)).astype(np.int32)
                short = token >> np.uint64(24)
                by = np.argsort(bucket, kind="stable")
                bucket, short, ref = bucket[by], short[by], ref[by]
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                # The slice's name ties its parts together again; its classes travel once, with what it settled itself.
                name = int(tx.mix(np.array([marks.sum() + np.uint64(len(marks))], np.uint64)).view(np.int64)[0])
                packed: tuple[list, ...] = ([int(bucket[0])], [name], [marks.tobytes()], [b""], [b""], [local.tobytes()])
                for a, b in zip(edge, np.append(edge[1:], len(bucket)), strict=True):
                    part = short[a:b]
                    tokens = (part >> np.uint64(8)).astype(np.uint32).tobytes() + (part & np.uint64(255)).astype(np.uint8).tobytes()
                    for column, value_ in zip(packed, (int(bucket[a]), name, b"", tokens, ref[a:b].tobytes(), b""), strict=True):
                        column.append(value_)
                yield pa.RecordBatch.from_arrays([pa.array(packed[0], pa.int32()), pa.array(packed[1], pa.int64()), *[pa.array(p, pa.binary()) for p in packed[2:]]], ["bucket", "slice", "marks", "tokens", "ref", "local"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, keys, refs, names, frequent = [], [], [], [], []
        for name, marks, tokens, ref, local in zip(pdf["slice"], pdf["marks"], pdf["tokens"], pdf["ref"], pdf["local"], strict=True):
            if marks:
                rows.append((name % buckets, name, marks, b"", local))
                continue
            n = len(tokens) // 5
            keys.append((np.frombuffer(tokens, np.uint32, n).astype(np.uint64) << np.uint64(8)) | np.frombuffer(tokens, np.uint8, n, 4 * n))
            refs.append(np.frombuffer(ref, np.uint16).astype(np.int64) + (len(names) << 16))
            names.append(name)
        if names:
            key, ref = np.concatenate(keys), np.concatenate(refs)
            order = np.argsort(key, kind="stable")
            key, ref = key[order], ref[order]
            same = key[1:] == key[:-1]
            several = np.append(same, False) | np.append(False, same)
            edge = np.flatnonzero(np.append(True, ~same))
            times = np.diff(np.append(edge, len(key)))
            top = np.flatnonzero(times >= FEW)
            top = top[np.argsort(-times[top], kind="stable")][: max(1, OFTEN // buckets)]
            levels = np.log2(times[top]).astype(np.uint8)
            frequent.append((0, 0, b"", b"", b"", key[edge[top]].tobytes(), levels.tobytes()))
            found, number = np.unique(ref[several & ((ref & 65535) != alone)], return_counts=True)
            # Packed by groups of slices, which a second step sums up.
            slices, edge, size = np.unique(found >> 16, return_index=True, return_counts=True)
            for i, a, b in zip(slices, edge, edge + size, strict=True):
                rows.append((names[i] % buckets, names[i], b"", (found[a:b] & 65535).astype(np.uint16).tobytes(), number[a:b].astype(np.int32).tobytes()))
        rows = [(*r, None, None) for r in rows] + frequent
        return pd.DataFrame(rows, columns=["group", "slice", "marks", "ref", "number", "often", "times"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        out_cls, out_shared = [], []
        for _, parts in pdf.groupby("slice"):
            whole = parts[parts["marks"].map(len) > 0].iloc[0]
            cls = np.frombuffer(whole["marks"], np.int64)
            shared = np.zeros(len(cls), np.int64)
            for ref, number in zip(parts["ref"], parts["number"], strict=True):
                if ref:
                    np.add.at(shared, np.frombuffer(ref, np.uint16), np.frombuffer(number, np.int32))
                else:
                    shared += np.frombuffer(number, np.int32)
            out_cls.append(cls[shared > 0])
            out_shared.append(shared[shared > 0])
        return pd.DataFrame({"cls": np.concatenate(out_cls), "shared": np.concatenate(out_shared)})

    sent = docs.select("text").mapInArrow(send, "bucket int, slice long, marks binary, tokens binary, ref binary, local binary")
    met = sent.groupBy("bucket").applyInPandas(meet, "group int, slice long, marks binary, ref binary, number binary, often binary, times binary")
    met = store(met, "shared")
    parts = met.where("often IS NULL").drop("often", "times")
    shared = parts.groupBy("group").applyInPandas(add, "cls long, shared long").groupBy("cls").agg(F.max("shared").alias("shared"))
    return shared, met.where("often IS NOT NULL").select("often", "times")


class Rarity:
    """An order of shingles: by how often they occur, where they are frequent, then by hash.

    Any order is right for `_prefix`, as long as all sets follow the same one; rare shingles first keep few classes at each.
    """

    def __init__(self, frequent: DataFrame):
        rows = frequent.collect()
        short = np.frombuffer(b"".join(r.often for r in rows), np.uint64)
        level = np.frombuffer(b"".join(r.times for r in rows), np.uint8)
        order = np.lexsort((level, short))
        # Shingles that agree in 40 bits count as one.
        last = np.append(short[order][1:] != short[order][:-1], True)[: len(order)]
        self.short, self.level = short[order][last], level[order][last]

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.short):
            return np.zeros(len(tokens), np.uint8)
        short = tokens >> np.uint64(24)
        at = np.minimum(np.searchsorted(self.short, short), len(self.short) - 1)
        return np.where(self.short[at] == short, self.level[at], 0).astype(np.uint8)


def _prefix(size: int) -> int:
    """How many first shingles of a set of ``size`` must hold one of any set that links to it."""
    return size - -(-NEED * size // OF) + 1


def _point(tokens: np.ndarray) -> np.ndarray:
    """The group of each shingle of a set, in order: its counts per group in a short form."""
    return np.sort((tokens % np.uint64(FINE_GROUPS)).astype(np.uint16))


def _coarse(point: np.ndarray) -> np.ndarray:
    """Counts of the groups of the tree, of which each holds a fixed part of the groups of a point."""
    return np.bincount(point % GROUPS, minlength=GROUPS).astype(np.int32)


def _numbered(point: np.ndarray) -> np.ndarray:
    """A point as distinct numbers: the k-th shingle of a group is told from the others."""
    first = np.searchsorted(point, point)
    return (point.astype(np.int64) << 32) | (np.arange(len(point)) - first)


def _bound(x: np.ndarray, y: np.ndarray) -> int:
    """At most so many shingles are in both sets: the sum of the coordinate minima of two numbered points."""
    return len(np.intersect1d(x, y, assume_unique=True))


def _points(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_point(np.frombuffer(t.as_buffer(), np.uint64)).tobytes() for t in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("n"), pa.array(out, pa.binary())], ["cls", "n", "point"])

    return sets.mapInArrow(run, "cls long, n long, point binary")


def _links(pairs: DataFrame, sets: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose sets reach the similarity; ``points``, if given, sort out most others first."""

    def filtered(test):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column("x"), batch.column("y")
                ok = pa.array([test(x[i], y[i]) for i in range(batch.num_rows)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

        return run

    def may(x: pa.Scalar, y: pa.Scalar) -> bool:
        x, y = np.frombuffer(x.as_buffer(), np.uint16), np.frombuffer(y.as_buffer(), np.uint16)
        both = _bound(_numbered(x), _numbered(y))
        return OF * both >= NEED * (len(x) + len(y) - both)

    def do(x: pa.Scalar, y: pa.Scalar) -> bool:
        x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return OF * both >= NEED * (len(x) + len(y) - both)

    def joined(pairs: DataFrame, of: DataFrame, column: str, test) -> DataFrame:
        x = of.select(F.col("cls").alias("a"), F.col(column).alias("x"))
        y = of.select(F.col("cls").alias("b"), F.col(column).alias("y"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(filtered(test), "a long, b long")

    return joined(pairs if points is None else joined(pairs, points, "point", may), sets, "tokens", do)


class CountTree:
    """R-tree over count vectors: leaves of points in the order of size and main counts, boxes of coordinate ranges above.

    Labels that many points bear lie together, so that boxes of one label alone are skipped by its own points.
    """

    def __init__(self, points: np.ndarray, size: np.ndarray, label: np.ndarray | None = None):
        points = points.astype(np.int32)
        label = np.arange(len(size)) if label is None else label
        _, at, many = np.unique(label, return_inverse=True, return_counts=True)
        spread = points.std(axis=0).argsort()[::-1][:3]
        self.order = np.lexsort((*[points[:, s] for s in spread], size, np.where(many[at] >= LEAF, at, -1)))
        self.points, self.size, self.label = points[self.order], size[self.order], at[self.order]
        self.own = at
        self.levels = []
        high, least, most, low_label, high_label = self.points, self.size, self.size, self.label, self.label
        while len(high) > 1 or not self.levels:
            cut = np.arange(0, len(high), LEAF if not self.levels else FAN)
            high, least, most = np.maximum.reduceat(high, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            low_label, high_label = np.minimum.reduceat(low_label, cut), np.maximum.reduceat(high_label, cut)
            self.levels.append((high, least, most, low_label, high_label))

    @staticmethod
    def _admits(bound: np.ndarray, size: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether ``bound`` shared shingles can link a set of ``size`` with one of ``least`` to ``most``."""
        small = np.maximum(least, -(-NEED * size // OF))
        fits = (small <= most) & (NEED * small <= OF * size)
        return fits & (OF * bound >= NEED * (size + small - bound))

    def _pass(self, point: np.ndarray, size: np.ndarray, own: np.ndarray, query: np.ndarray, at: np.ndarray, level: tuple) -> np.ndarray:
        """Which (``query``, ``at``) stay: sizes and labels first, then the bound, a bounded number at a time."""
        high, least, most, low_label, high_label = level
        mine, small = size[query], np.maximum(least[at], -(-NEED * size[query] // OF))
        ok = (small <= most[at]) & (NEED * small <= OF * mine) & ~((low_label[at] == own[query]) & (high_label[at] == own[query]))
        which = np.flatnonzero(ok)
        for a in range(0, len(which), BOUNDS):
            w = which[a : a + BOUNDS]
            bound = np.minimum(high[at[w]], point[query[w]]).sum(axis=1)
            ok[w] = self._admits(bound, size[query[w]], least[at[w]], most[at[w]])
        return ok

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Positions (of the given order of points) whose bound admits a link."""
        return self.search_all(point[None], np.array([size]), np.array([-1]))[1]

    def search_all(self, point: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, position in the given order of points) whose bound admits a link and whose labels differ."""
        point = point.astype(np.int32)
        query, at = np.arange(len(size)), np.zeros(len(size), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            ok = self._pass(point, size, own, query, at, self.levels[depth])
            fan = LEAF if depth == 0 else FAN
            limit = len(self.points) if depth == 0 else len(self.levels[depth - 1][0])
            query, at = np.repeat(query[ok], fan), (at[ok][:, None] * fan + np.arange(fan)).ravel()
            query, at = query[at < limit], at[at < limit]
        ok = self._pass(point, size, own, query, at, (self.points, self.size, self.size, self.label, self.label))
        return query[ok], self.order[at[ok]]


def _heads(sets: DataFrame, most: int | None = None, rarity: Rarity | None = None) -> DataFrame:
    """(``token``, ``cls``): the first shingles of which two linking sets share one, or ``most`` of them.

    They are the first by hash, or by ``rarity``.
    """
    held = sets.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            for low in range(0, batch.num_rows, 256):
                tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in batch.column("tokens").slice(low, 256)]
                count = [min(_prefix(len(t)), most or len(t)) for t in tokens]
                if held.value is not None:
                    ends = np.cumsum([len(t) for t in tokens])
                    levels = np.split(held.value.levels(np.concatenate(tokens)), ends[:-1])
                    tokens = [t[np.argsort(v, kind="stable")] if v.any() else t for t, v in zip(tokens, levels, strict=True)]
                out = np.concatenate([t[:c] for t, c in zip(tokens, count, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), pa.array(np.repeat(cls[low : low + 256], count))], ["token", "cls"])

    return sets.mapInArrow(run, "token long, cls long")


def _named(heads: DataFrame, labels: DataFrame) -> DataFrame:
    """``heads`` with the component of each class as ``label``."""
    return heads.join(labels, heads["cls"] == labels["node"], "left").select("token", "cls", F.coalesce("label", "cls").alias("label"))


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after further links; what was found before goes in as one link a class."""
    return components(links if labels is None else links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def _between(named: DataFrame) -> DataFrame:
    """Pairs of one class per component that meets at a shingle with one of the component most present there.

    Among equally present ones, and within a component, chance picks a class anew at each shingle.
    """
    chance = F.struct(F.xxhash64("cls", "token").alias("h"), "cls")
    of_each = named.groupBy("token", "label").agg(F.count("*").alias("weight"), F.min(chance)["cls"].alias("cls"))
    centre = of_each.groupBy("token").agg(F.max(F.struct("weight", F.xxhash64("cls", "token").alias("h"), "cls"))["cls"].alias("b"), F.count("*").alias("many"))
    pairs = of_each.join(centre.where("many > 1"), "token").where("b <> cls")
    return pairs.select(F.least("b", "cls").alias("a"), F.greatest("b", "cls").alias("b")).distinct()


def _candidates(named: DataFrame, points: DataFrame, parts: int) -> DataFrame:
    """Pairs of classes of different components that share a first shingle and whose points admit a link."""
    mixed = named.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
    # Shingles at which the same classes meet make one block.
    blocks = named.join(mixed, "token")
    met = blocks.groupBy("token").agg(
        F.count("*").alias("many"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y")
    )
    chosen = met.groupBy("many", "x", "y").agg(F.min("token").alias("token")).select("token")
    # A class goes once to each part that holds one of its shingles.
    own = blocks.join(chosen, "token").groupBy("cls").agg(F.min("label").alias("label"), F.collect_list("token").alias("tokens"))

    def join(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls")
        cls, label, size = pdf["cls"].to_numpy(), pdf["label"].to_numpy(), pdf["n"].to_numpy()
        tokens = [np.asarray(t) for t in pdf["tokens"]]
        here = [t[np.mod(t, parts) == key[0]] for t in tokens]
        token, owner = np.concatenate(here), np.repeat(np.arange(len(here)), [len(t) for t in here])
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        own = [frozenset(t.tolist()) for t in tokens]
        fine = [np.frombuffer(p, np.uint16) for p in pdf["point"]]
        point = np.stack([_coarse(p) for p in fine])
        fine = [_numbered(p) for p in fine]
        n = np.int64(len(cls))
        found: set[tuple[int, int]] = set()

        def judge(codes: list[np.ndarray]) -> None:
            unique = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
            for i, j in zip((unique // n).tolist(), (unique % n).tolist(), strict=True):
                # A pair belongs to the part of the least shingle at which its classes meet.
                if min(own[i] & own[j]) % parts == key[0]:
                    both = _bound(fine[i], fine[j])
                    if OF * both >= NEED * (int(size[i]) + int(size[j]) - both):
                        found.add((int(cls[i]), int(cls[j])))

        codes: list[np.ndarray] = []
        edge = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        for a, b in zip(edge, np.append(edge[1:], len(token)), strict=True):
            block = owner[a:b]
            tree = CountTree(point[block], size[block], label[block])
            for low in range(0, len(block), QUERIES):
                mine = block[low : low + QUERIES]
                query, near = tree.search_all(point[mine], size[mine], tree.own[low : low + QUERIES])
                i, j = mine[query], block[near]
                codes.append((i * n + j)[j > i])
                if sum(map(len, codes)) > PAIRS:
                    judge(codes)
                    codes = []
        judge(codes)
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    places = F.array_distinct(F.transform("tokens", lambda t: F.pmod(t, F.lit(parts).cast("long"))))
    return own.withColumn("part", F.explode(places)).join(points, "cls").groupBy("part").applyInPandas(join, "a long, b long")


def _marked(texts: DataFrame, mark: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``texts`` whose ``mark`` may be among ``keys``: all that are, and some others.

    A map of `MAP_BITS` bits, of fixed size and therefore broadcast, tells; a full map lets all rows pass.
    """
    bit = F.pmod(F.col(key), F.lit(MAP_BITS).cast("long"))
    bits = keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    own = F.pmod(F.col(mark), F.lit(MAP_BITS).cast("long"))
    placed = texts.withColumn("_at", F.bitmap_bit_position(own)).withColumn("_own", F.bitmap_bucket_number(own))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = placed.join(F.broadcast(bits), F.col("_own") == F.col("_bucket")).withColumn("_byte", byte)
    return held.where(F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1 = 1")).select(*texts.columns)


def similar_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``cls``, ``component_id`` of every document.

    ``cls`` names the shingle set (null without words), ``component_id`` is the least doc_id of the documents
    reached by links. A document links to another if they share at least 75 % of the shingles of both. Null and
    wordless texts have no shingles and link to nothing; texts of fewer than five words are one shingle; a
    null doc_id links like any other and is no id of a component unless no member has one; repeated rows are
    copies of each other; an empty table gives no rows. Only doc_id and text are read.
    """
    rows = store(shingle_sets(docs), "shingle-sets")
    total = rows.agg(F.sum("n_shingles")).first()[0]
    spark = docs.sparkSession
    buckets = max(1, -(-(total or 0) // TOKENS_PER_BUCKET))
    shared, frequent = shared_shingles(docs, buckets)
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("cls")
        .agg(
            F.max("n_shingles").alias("n"),
            F.count("*").alias("many"),
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
        )
    )
    left = store(classes.join(shared, "cls").where(OF * F.col("shared") >= NEED * F.col("n")), "classes")
    wanted = left.select(F.col("cls").alias("_cls"), F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_mark"))
    texts = _marked(texts, "_mark", wanted, "_key")
    held = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_id"]) & (texts["_mark"] == wanted["_key"])).select(F.col("_cls").alias("cls"), "text")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column("text")):
                _, value, size, _ = _sets(data, offsets)
                end = np.cumsum(size)
                packed = [value[e - s : e].tobytes() for s, e in zip(size, end, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("cls").slice(low, high - low), pa.array(size.astype(np.int64)), pa.array(packed, pa.binary())], ["cls", "n", "tokens"])

    sets = store(held.mapInArrow(tokens, "cls long, n long, tokens binary").dropDuplicates(["cls"]), "sets")

    points = store(_points(sets), "points")
    labels = None
    for most in STARS:
        few = _heads(sets, most)
        named = few.withColumn("label", F.col("cls")) if labels is None else _named(few, labels)
        labels = _joined(labels, store(_links(_between(named), sets, points), "links"))
    heads = store(_heads(sets, rarity=Rarity(frequent)), "heads")
    parts = tasks_for(spark, heads.count(), HEADS_PER_PART)
    labels = _joined(labels, store(_links(_candidates(_named(heads, labels), points, parts), sets), "links"))
    grouped = left.join(labels, left["cls"] == labels["node"], "left").select("cls", "least", F.coalesce("label", "cls").alias("label"))
    least = grouped.groupBy("label").agg(F.min("least").alias("component"))
    named = grouped.join(least, "label").select(F.col("cls").alias("_cls"), "component")
    return rows.join(named, F.when(rows["n_shingles"] > 0, rows["cls"]) == named["_cls"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("cls")).alias("cls"),
        F.when(F.col("_cls").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_key",
    )


def jaccard_join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``cls`` of every document; see `similar_classes`."""
    return similar_classes(docs).select("doc_id", "n_shingles", "component_id", "cls")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document per component, the one of the least doc_id, with all its columns.

    Documents without words have no component and stay. Of rows that repeat the kept doc_id one stays.
    """
    found = store(similar_classes(docs), "components")
    kept = found.where(F.col("n_shingles") == 0).select("doc_id", "text_key", F.lit(True).alias("wordless"))
    with_words = (
        found.where("n_shingles > 0")
        .groupBy(F.coalesce("component_id", F.col("cls")).alias("_c"), F.col("component_id").isNull().alias("_n"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("_first"))
        .select(F.col("_first.doc_id").alias("doc_id"), F.col("_first.text_key").alias("text_key"), F.lit(False).alias("wordless"))
    )
    chosen = kept.union(with_words).distinct().toDF("_id", "_key", "_wordless")
    names = docs.columns
    held = docs.select(F.struct(*names).alias("_doc"), F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_mark"))
    joined = held.join(chosen, held["_own"].eqNullSafe(chosen["_id"]) & (held["_mark"] == chosen["_key"]))
    # Rows that repeat a kept document pass the join as well; only if there are any, they are thinned out.
    repeated = store(found.where("n_shingles > 0").groupBy("doc_id", "text_key").count().where("count > 1").select(F.col("doc_id").alias("_rid"), F.col("text_key").alias("_rkey")), "repeated")
    if not repeated.isEmpty():
        joined = joined.join(repeated, joined["_own"].eqNullSafe(repeated["_rid"]) & (joined["_mark"] == repeated["_rkey"]), "left")
        again = joined.where("_rkey IS NOT NULL").dropDuplicates(["_own", "_mark"])
        joined = joined.where("_rkey IS NULL").unionByName(again)
    return joined.select(*[F.col("_doc")[c].alias(c) for c in names])
