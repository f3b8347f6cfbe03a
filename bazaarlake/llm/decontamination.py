"""Benchmark decontamination by fingerprints of item-sized windows.

Both sides are lower-cased words cut of outer punctuation, taken in five-word shingles. A window of a document
is as long as an item, wherever it starts; a document of fewer shingles is one window. Its similarity to an item
is the share of the item's shingle weight that it holds, in any order; a shingle of several items weighs as much less.

Fingerprints are SimHashes of ``BITS`` signs. Each distinct shingle votes along a random normal direction, by the square
root of its weight, and words of no item have no vote: a window that holds a share s of an item and nothing of others then
has a cosine of the square root of s to it, whatever the weights, which is 43 bits of 256 with a deviation of 6 at s = 0.75.
Shingles of other items in the window turn it away further.

Windows begin at a shingle of an item of their size, as any other window holds no more than the next one that does. Those too
light for every item of their size are left out. An index of ``BLOCKS`` parts of the fingerprint finds all items within
``RADIUS`` bits of the rest: one part at least differs in no more than three bits, of which the index spells out one and
the search two. Each pair found is judged exactly, by a sliding sum over the document's hits of the item's shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import text as tx
from bazaarlake.llm.storage import store

SHINGLE, SIMILARITY = 5, 0.75
#: Postings looked at together; whole documents, so one that has more is looked at alone.
HITS_PER_STEP = 1 << 20
#: Items of a block of the benchmark; each block is sent to the tasks as a whole, whatever the benchmark's size.
ITEMS_PER_BLOCK = 5_000
#: Bytes of text of such a block (or one item, if that is longer).
BYTES_PER_BLOCK = 8 << 20
#: Blocks that one written pass over the documents looks at.
BLOCKS_PER_PASS = 8
BITS, BLOCKS, RADIUS = 256, 16, 63
#: Hits of which the votes are held together, and windows searched together.
VOTES_PER_STEP, WINDOWS_PER_STEP = 1 << 12, 1 << 9
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*range(0x21), *(ord(c) for c in "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~-")]] = True


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = tx.Words(data, offsets, between=_BETWEEN)
    return (*tx.shingles(words, SHINGLE), np.maximum(words.counts - SHINGLE + 1, np.minimum(words.counts, 1)))


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs in which all keys are equal."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _steps(key: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of whole runs of equal keys, of about ``HITS_PER_STEP`` each."""
    edge = np.append(_edges(key), len(key))
    total = np.concatenate([[0], np.cumsum(size)])[edge]
    low = 0
    while low < len(edge) - 1:
        high = max(int(np.searchsorted(total, total[low] + HITS_PER_STEP, "right")) - 1, low + 1)
        yield int(edge[low]), int(edge[high])
        low = high


def _masks(flips: int) -> np.ndarray:
    """All words of one part of the fingerprint with at most so many bits set."""
    return np.array([sum(1 << b for b in some) for n in range(flips + 1) for some in combinations(range(BITS // BLOCKS), n)], np.int64)


def _votes(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The vote of each shingle on each bit: near normal, fixed by the shingle, in whole numbers so that sums are exact."""
    word = tx.mix(value[:, None] ^ tx.mix(np.arange(1, BITS + 1, dtype=np.uint64)))
    total = np.full(word.shape, -2 * 0xFFFF, np.int64)
    for piece in range(4):
        total += ((word >> np.uint64(16 * piece)) & np.uint64(0xFFFF)).astype(np.int64)
    return total * np.rint(np.sqrt(weight) * 4096).astype(np.int64)[:, None]


def _prints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of summed votes, one row of 64-bit words each."""
    return np.packbits(sums > 0, axis=1).view(np.uint64)


@dataclass
class Benchmark:
    """Items as shingles: ``ids``; per item first shingle ``first`` and ``count``; shingle values and weights; the postings."""

    ids: np.ndarray
    first: np.ndarray
    count: np.ndarray
    value: np.ndarray
    weight: np.ndarray

    def __post_init__(self) -> None:
        owner = np.repeat(np.arange(len(self.ids)), self.count)
        self.known = np.unique(self.value)
        place = np.searchsorted(self.known, self.value)
        self.worth = np.zeros(len(self.known))
        self.worth[place] = self.weight
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.known >> np.uint64(44)).astype(np.int64)] = True
        own, token = tx.distinct(owner, place.astype(np.uint64))
        token = token.astype(np.int64)
        self.own, self.token = own, token
        self.total = np.bincount(own, self.worth[token], len(self.ids))
        order = np.argsort(token, kind="stable")
        self.holder = own[order]
        self.bounds = np.searchsorted(token[order], np.arange(len(self.known) + 1))

    @classmethod
    def of(cls, ids: list, texts: list[str], often: dict[int, int] | None = None) -> Benchmark:
        data = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(data), np.uint8)
        rows, _, value, counts = _shingles(raw, np.cumsum([0, *map(len, data)]))
        del rows
        return cls(np.array(ids, np.int64), np.cumsum(counts) - counts, counts, value, np.ones(len(value)))

    def weigh(self, often: dict[int, int]) -> Benchmark:
        """The same items with shingles weighted by how few items of the whole benchmark hold them."""
        weight = np.array([1.0 / often.get(int(v), 1) for v in self.value])
        return Benchmark(self.ids, self.first, self.count, self.value, weight)

    def hits(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the items' shingles among ``value``, and which shingle stands there."""
        if not len(value) or not len(self.known):
            return (np.zeros(0, np.int64),) * 2
        maybe = np.flatnonzero(self.seen[(value >> np.uint64(44)).astype(np.int64)])
        token = np.minimum(np.searchsorted(self.known, value[maybe]), len(self.known) - 1)
        ok = self.known[token] == value[maybe]
        return maybe[ok], token[ok]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
        """Sizes of the items that hold each shingle (bounds, then sizes), and the least weight of the items of each size."""
        token, size = tx.distinct(self.token, self.count[self.own].astype(np.uint64))
        light: dict[int, float] = {}
        for n, total in zip(self.count.tolist(), self.total.tolist(), strict=True):
            light[n] = min(total, light.get(n, total))
        return np.searchsorted(token, np.arange(len(self.known) + 1)), size.astype(np.int64), light

    @cached_property
    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints of the items, and for each part and word of it the items that differ there in one bit or none."""
        prints = np.zeros((len(self.ids), BITS // 64), np.uint64)
        held = np.unique(self.own)
        for low in range(0, len(held), 256):
            mine = held[low : low + 256]
            a, b = np.searchsorted(self.own, [mine[0], mine[-1] + 1])
            votes = _votes(self.known[self.token[a:b]], self.worth[self.token[a:b]])
            prints[mine] = _prints(np.add.reduceat(votes, _edges(self.own[a:b])))
        key = self._keys(prints[held], _masks(1))
        item = np.broadcast_to(held[:, None, None], key.shape).ravel()
        order = np.argsort(key.ravel(), kind="stable")
        bounds = np.searchsorted(key.ravel()[order], np.arange((BLOCKS << (BITS // BLOCKS)) + 1))
        return prints, bounds, item[order]

    @staticmethod
    def _keys(prints: np.ndarray, masks: np.ndarray) -> np.ndarray:
        part = np.ascontiguousarray(prints).view(np.uint16).astype(np.int64) ^ (np.arange(BLOCKS) << (BITS // BLOCKS))
        return part[:, :, None] ^ masks

    def near(self, doc: np.ndarray, at: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Pairs (document times items plus item) of which a window and the item of its size lie within the radius.

        ``at`` rises; documents, shingles and places belong to all hits of a slice.
        """
        bounds, sizes, light = self.sizes
        kinds = bounds[token + 1] - bounds[token]
        start, size = np.repeat(np.arange(len(at)), kinds), sizes[_runs(bounds[token], kinds)]
        first = np.searchsorted(doc, doc)
        order = np.lexsort((at, token, doc))
        again = np.zeros(len(at), bool)
        again[1:] = (token[order][1:] == token[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        behind = np.zeros(len(at), np.int64)
        behind[order] = np.where(again, np.concatenate([[0], order[:-1] + 1]), 0)
        pairs = [np.zeros(0, np.int64)]
        for n in np.unique(size).tolist():
            # A hit counts in windows that reach it and begin behind the last hit of the same shingle.
            low = np.maximum(np.maximum(first, behind), np.searchsorted(at, at - n, "right"))
            worth = self.worth[token]
            held = np.cumsum(np.bincount(low, worth, len(at) + 1) - np.bincount(np.arange(1, len(at) + 1), worth, len(at) + 1))
            mine = start[size == n]
            mine = mine[held[mine] >= (SIMILARITY - 1e-6) * light[n]]
            for a, prints in self._window_prints(n, mine, at, token, low):
                pairs.append(self._within(n, doc[mine[a : a + len(prints)]], prints))
        return np.unique(np.concatenate(pairs))

    def _window_prints(self, n: int, start: np.ndarray, at: np.ndarray, token: np.ndarray, low: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Fingerprints of the windows of ``n`` shingles at the hits ``start``, some at a time, with the number of the first."""
        a = 0
        while a < len(start):
            begin = int(start[a])
            b = int(np.searchsorted(start, begin + VOTES_PER_STEP))
            end = int(start[b - 1]) + 1
            hit = np.arange(begin, int(np.searchsorted(at, at[end - 1] + n)))
            since = np.maximum(low[hit], begin)
            # The sums change from one asked window to the next only: a hit enters at the first that holds it, leaves behind the last.
            enter, leave = np.minimum(np.searchsorted(start, since), b) - a, np.minimum(np.searchsorted(start, hit, "right"), b) - a
            use = enter < leave
            hit, enter, leave = hit[use], enter[use], leave[use]
            seen, which = np.unique(token[hit], return_inverse=True)
            votes = _votes(self.known[seen], self.worth[seen])[which]
            sums = np.zeros((b - a + 1, BITS), np.int64)
            for place, sign in ((enter, 1), (leave, -1)):
                order = np.argsort(place, kind="stable")
                edge = _edges(place[order])
                sums[place[order][edge]] += sign * np.add.reduceat(votes[order], edge)
            yield a, _prints(np.cumsum(sums, axis=0)[:-1])
            a = b

    def _within(self, n: int, doc: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Pairs of a document and an item of ``n`` shingles of which the fingerprints lie within the radius."""
        known, bounds, item = self.index
        out = []
        for low in range(0, len(prints), WINDOWS_PER_STEP):
            own = prints[low : low + WINDOWS_PER_STEP]
            key = self._keys(own, _masks(2)).reshape(len(own), -1)
            many = bounds[key + 1] - bounds[key]
            window = np.repeat(np.arange(len(own)), many.sum(axis=1))
            other = item[_runs(bounds[key].ravel(), many.ravel())]
            fits = self.count[other] == n
            window, other = window[fits], other[fits]
            close = np.bitwise_count(own[window] ^ known[other]).sum(axis=1, dtype=np.int64) <= RADIUS
            out.append(np.unique(doc[low + window[close]] * len(self.ids) + other[close]))
        return np.concatenate(out)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, similarity) of the best window of each pair that fingerprints find and that is similar enough."""
        rows, _, value, _ = _shingles(data, offsets)
        at, token = self.hits(value)
        return self._judge(rows, at, token, self.near(rows[at], at, token))

    def match(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for all pairs that share a shingle; what the search is measured against."""
        rows, _, value, _ = _shingles(data, offsets)
        at, token = self.hits(value)
        return self._judge(rows, at, token)

    def _judge(self, rows: np.ndarray, at: np.ndarray, token: np.ndarray, found: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that are similar enough, of those found or of all."""
        if found is not None:
            mine = np.isin(rows[at], found // max(len(self.ids), 1))
            at, token = at[mine], token[mine]
        order = np.lexsort((at, token, rows[at]))
        at, token = at[order], token[order]
        edge = _edges(rows[at], token)
        many = np.diff(np.append(edge, len(at)))
        doc, token = rows[at[edge]], token[edge]
        holders = self.bounds[token + 1] - self.bounds[token]
        out: list[tuple[int, int, float]] = []
        for a, b in _steps(doc, holders):
            which = np.repeat(np.arange(a, b), holders[a:b])
            pair = doc[which] * len(self.ids) + self.holder[_runs(self.bounds[token[a:b]], holders[a:b])]
            if found is not None:
                mine = np.isin(pair, found)
                which, pair = which[mine], pair[mine]
            if not len(pair):
                continue
            by = np.argsort(pair, kind="stable")
            which, pair = which[by], pair[by]
            first = _edges(pair)
            # No window holds more than the whole document.
            enough = np.add.reduceat(self.worth[token[which]], first) >= (SIMILARITY - 1e-6) * self.total[pair[first] % len(self.ids)]
            keep = np.repeat(enough, np.diff(np.append(first, len(pair))))
            which, pair = which[keep], pair[keep]
            for c, d in _steps(pair, many[which]):
                out += self._best(pair[c:d], token[which[c:d]], at[_runs(edge[which[c:d]], many[which[c:d]])], many[which[c:d]])
        out.sort()
        return np.array([p[0] for p in out], np.int64), np.array([p[1] for p in out], np.int64), np.array([p[2] for p in out])

    def _best(self, pair: np.ndarray, token: np.ndarray, at: np.ndarray, many: np.ndarray) -> list[tuple[int, int, float]]:
        """The pairs whose best window is similar; of each pair and shingle, ``many`` places ``at``."""
        fresh = np.zeros(len(at), bool)
        fresh[np.cumsum(many) - many] = True
        pair, token = np.repeat(pair, many), np.repeat(token, many)
        order = np.lexsort((at, pair))
        rank = np.empty(len(at), np.int64)
        rank[order] = np.arange(len(at))
        # A hit counts for windows that begin behind the last hit of the same shingle and reach it.
        behind = np.where(fresh, 0, np.concatenate([[0], rank[:-1] + 1]))[order]
        pair, token, at = pair[order], token[order], at[order]
        first = _edges(pair)
        size = np.diff(np.append(first, len(pair)))
        span = int(at.max()) + 1
        base = np.repeat(np.arange(len(first)) * span, size)
        reach = np.searchsorted(base + at, base + np.maximum(at - self.count[pair % len(self.ids)] + 1, 0))
        low = np.maximum(behind, reach)
        worth = self.worth[token]
        held = np.cumsum(np.bincount(low, worth, len(at) + 1) - np.bincount(np.arange(1, len(at) + 1), worth, len(at) + 1))[:-1]
        most = np.maximum.reduceat(held, first)
        item = pair[first] % len(self.ids)
        out = []
        for n in np.flatnonzero(most >= (SIMILARITY - 1e-6) * self.total[item]).tolist():
            a, b, i = int(first[n]), int(first[n] + size[n]), int(item[n])
            start = a + int(held[a:b].argmax())
            end = int(np.searchsorted(at[start:b], at[start] + self.count[i])) + start
            share = float(self.worth[np.unique(token[start:end])].sum() / self.total[i])
            if share >= SIMILARITY - 1e-9:
                out.append((int(pair[a]) // len(self.ids), i, min(share, 1.0)))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The benchmark in blocks of bounded length; a block holds whole items. Items without words match nothing."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["rows"] // ITEMS_PER_BLOCK), -(-size["bytes"] // BYTES_PER_BLOCK))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column("text")):
                rows, _, value, _ = _shingles(data, offsets)
                rows, value = tx.distinct(rows, value)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], ["value"])

    often = items.select("text").mapInArrow(sized, "value long").groupBy("value").count().where("count > 1")
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        held = Benchmark.of([r.item_id for r in rows], [r.text for r in rows])
        if not len(held.value):
            continue
        mine = items.sparkSession.createDataFrame([(int(v),) for v in np.unique(held.value).view(np.int64)], "value long")
        shared = often.join(F.broadcast(mine), "value").collect()
        yield held.weigh({int(np.int64(r["value"]).view(np.uint64)): r["count"] for r in shared})


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every document with ``hits``, an array of (item_id, similarity) by item.

    Texts are read whole; a null text is empty and matches nothing; an item of fewer than five words is one
    shingle; items of one id are judged by each of their texts; repeated rows get equal results; an empty
    benchmark gives no hits, an empty table no rows. Other columns are carried as they are.
    """
    names = [f"k{i}" for i in range(len(keep))]
    hit = "array<struct<item_id:long,similarity:double>>"
    held = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col("text").alias("_text"), F.array().cast(hit).alias("_hits"))
    schema = held.schema
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64())]))
    for done, block in enumerate(_blocks(benchmark), 1):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text, had = batch.column(len(names)), batch.column(len(names) + 1)
                for low, high, data, offsets in tx.slices(text):
                    doc, item, share = items.value.search(data, offsets)
                    hits = had.slice(low, high - low).to_pylist()
                    for d, i, s in zip(doc.tolist(), item.tolist(), share.tolist(), strict=True):
                        hits[d] = [*hits[d], {"item_id": int(items.value.ids[i]), "similarity": s}]
                    cut = [batch.column(c).slice(low, high - low) for c in range(len(names) + 1)]
                    yield pa.RecordBatch.from_arrays([*cut, pa.array(hits, kind)], schema.names)

        held = held.mapInArrow(run, schema)
        if done % BLOCKS_PER_PASS == 0:
            held = store(held, "decontamination")
    return held.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.array_sort("_hits").alias("hits"))


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``contaminated``, ``item_ids``, ``similarity`` (of the nearest item, else null) of every document."""
    found = contaminated(docs, benchmark, ["doc_id"])
    return found.select(
        "doc_id",
        (F.size("hits") > 0).cast("int").alias("contaminated"),
        F.array_distinct(F.transform("hits", lambda h: h["item_id"])).alias("item_ids"),
        F.round(F.array_max(F.transform("hits", lambda h: h["similarity"])), 6).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    return contaminated(docs, benchmark, docs.columns).where(F.size("hits") == 0).select(*docs.columns)
