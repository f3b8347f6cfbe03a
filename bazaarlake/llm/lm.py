"""Stupid-backoff scores of documents under the bigrams of the whole corpus.

Words and bigrams are counted over all documents. A bigram that the corpus holds at least ``min_count`` times scores
its count over that of the bigrams with its first word; any other scores the share of its second word, at the backoff factor.

The tables of counts are partitioned by hash. The bigrams of the documents, packed by slice, go to the partition of their
first word, where they are counted and scored at once; what backs off goes on to the partition of the second word.
Words above a set share of the corpus, of which there can be no more than one over that share, are sent along with
their counts: they back off without a trip, and bigrams that begin with one are filed by the whole bigram, so that
no partition gets all bigrams of a frequent word. Words are named by the upper 48 bits of their hash, documents by
their place in a slice; the sums of a slice meet again at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import text as tx
from bazaarlake.llm.storage import store

BACKOFF, MIN_COUNT = 0.4, 2
BYTES_PER_BUCKET = 8 << 20
#: Larger slices repeat fewer words among themselves.
SLICE_BYTES = 4 << 20
#: A word of at least this share of all words is frequent: at most 100,000 are.
FREQUENT_SHARE = 1e-5
_HALF = np.uint64(16)


def _pack48(x: np.ndarray) -> bytes:
    return (x >> _HALF).astype(np.uint32).tobytes() + (x & np.uint64(65535)).astype(np.uint16).tobytes()


def _unpack48(packed: bytes) -> np.ndarray:
    n = len(packed) // 6
    return (np.frombuffer(packed, np.uint32, n).astype(np.uint64) << _HALF) | np.frombuffer(packed, np.uint16, n, 4 * n)


def _pack_counts(x: np.ndarray) -> bytes:
    """Numbers in the narrowest unsigned type that holds them, named by the first byte."""
    kind = next(k for k in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << 8 * k)
    return bytes([kind]) + x.astype(f"u{kind}").tobytes()


def _unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", -1, 1).astype(np.int64)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs in which all keys are equal."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _sizes(edge: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(edge, n))


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edge = _edges(bucket[order])
    for a, n in zip(edge, _sizes(edge, len(order)), strict=True):
        yield int(bucket[order[a]]), order[a : a + n]


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names)


def _word48(words: tx.Words) -> np.ndarray:
    return words.hash >> _HALF


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """A row per bucket of words: packed ``words`` (sorted), ``counts`` and ``lasts``, how often each ends a text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words = tx.Words(data, offsets)
                name = _word48(words)
                value, at, count = np.unique(name, return_inverse=True, return_counts=True)
                begins = np.zeros(len(name))
                begins[:-1] = words.row[1:] == words.row[:-1]
                last = count - np.bincount(at, begins, len(value)).astype(np.int64)
                columns: list[list] = [[], [], [], []]
                for b, mine in _by_bucket((value % np.uint64(buckets)).astype(np.int32)):
                    for column, part in zip(columns, (b, _pack48(value[mine]), _pack_counts(count[mine]), _pack_counts(last[mine])), strict=True):
                        column.append(part)
                yield _batch(columns, ["bucket", "words", "counts", "lasts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        word = np.concatenate([_unpack48(w) for w in pdf["words"]])
        order = np.argsort(word)
        edge = _edges(word[order])
        sums = [np.add.reduceat(np.concatenate([_unpack_counts(x) for x in pdf[c]])[order], edge) for c in ("counts", "lasts")] if len(edge) else [word, word]
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "words": [_pack48(word[order][edge])], "counts": [sums[0].astype(np.int64).tobytes()], "lasts": [sums[1].astype(np.int64).tobytes()]})

    schema = "bucket int, words binary, counts binary, lasts binary"
    return docs.select("text").mapInArrow(send, schema).groupBy("bucket").applyInPandas(add, schema)


def _frequent(words: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with a count of at least ``least``, their counts and how often they begin a bigram."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                word = _unpack48(batch.column("words")[i].as_py())
                count, last = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("counts", "lasts"))
                keep = count >= least
                yield pa.RecordBatch.from_arrays([pa.array(word[keep].view(np.int64)), pa.array(count[keep]), pa.array((count - last)[keep])], ["word", "n", "first"])

    rows = words.mapInArrow(pick, "word long, n long, first long").orderBy("word").toPandas()
    return rows["word"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64), rows["first"].to_numpy(np.int64)


def _by_slice(names: np.ndarray, code: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted ``code`` (slice number and 16 bits of row) packed as slice names, entries of each and rows."""
    number = code >> 16
    edge = _edges(number)
    return names[number[edge]].tobytes(), _pack_counts(_sizes(edge, len(code))), (code & 65535).astype(np.uint16).tobytes()


def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, min_count: int = MIN_COUNT) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` (sum over the bigrams, natural logarithm) and ``score`` (mean; null without bigrams).

    Words are lower-cased (A-Z) runs of non-blank bytes of the whole text, and bigrams stay within it. A null text
    is empty; documents of fewer than two words have log_score 0 and no score; every copy and repeated row counts in the
    corpus and is scored alike. Only doc_id and text are read; an empty table gives no rows.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BYTES_PER_BUCKET))
    words = store(word_counts(docs, buckets), "words")
    total = _total(words)
    common = docs.sparkSession.sparkContext.broadcast(_frequent(words, max(2.0, total * FREQUENT_SHARE)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.xxhash64("doc_id", "text").alias("mark"), "text")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, number = common.value[0], TaskContext.get().partitionId() << 32
        for batch in batches:
            marks = batch.column("mark").to_numpy()
            for low, high, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found = tx.Words(data, offsets)
                name = _word48(found)
                ok = np.flatnonzero(found.row[1:] == found.row[:-1])
                row, first, second = found.row[ok], name[ok], name[ok + 1]
                order = np.lexsort((row, second, first))
                row, first, second = row[order], first[order], second[order]
                edge = _edges(first, second, row)
                n = _sizes(edge, len(first))
                row, first, second = row[edge], first[edge], second[edge]
                place = np.where(np.isin(first, frequent), tx.mix(first * np.uint64(31) + second), first) % np.uint64(buckets)
                # Entries name a row of the slice; the slice's marks travel once.
                columns: list[list] = [[number % buckets], [number], [marks[low:high].tobytes()], *[[b""] for _ in range(6)]]
                for b, mine in _by_bucket(place.astype(np.int32)):
                    pair = _edges(first[mine], second[mine])
                    f, s = first[mine][pair], second[mine][pair]
                    head = _edges(f)
                    parts = (
                        b, number, b"", row[mine].astype(np.uint16).tobytes(), _pack48(f[head]), _pack_counts(_sizes(head, len(f))),
                        _pack48(s), _pack_counts(_sizes(pair, len(mine))), _pack_counts(n[mine]),
                    )
                    for column, part in zip(columns, parts, strict=True):
                        column.append(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[2:]]],
                    ["bucket", "slice", "marks", "ref", "first", "runs", "second", "many", "n"],
                )
                number += 1

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        frequent, frequent_n, frequent_first = common.value
        whole = pdf["marks"].map(len) > 0
        columns: list[list] = [[] for _ in range(7)]

        def put(*parts: object) -> None:
            for column, part in zip(columns, parts, strict=True):
                column.append(part)

        for b, name, marks in zip(pdf["bucket"][whole], pdf["slice"][whole], pdf["marks"][whole], strict=True):
            put(b, np.int64(name).tobytes(), b"", b"", b"", b"", marks)
        own, pdf = int(pdf["bucket"].iloc[0]), pdf[~whole]
        if len(pdf):
            names = pdf["slice"].to_numpy(np.int64)
            code = np.concatenate([np.frombuffer(r, np.uint16).astype(np.int64) + (k << 16) for k, r in enumerate(pdf["ref"])])
            many = [_unpack_counts(m) for m in pdf["many"]]
            first = np.concatenate([np.repeat(np.repeat(_unpack48(f), _unpack_counts(r)), m) for f, r, m in zip(pdf["first"], pdf["runs"], many, strict=True)])
            second = np.concatenate([np.repeat(_unpack48(s), m) for s, m in zip(pdf["second"], many, strict=True)])
            n = np.concatenate([_unpack_counts(x) for x in pdf["n"]])
            order = np.lexsort((second, first))
            code, first, second, n = code[order], first[order], second[order], n[order]
            edge = _edges(first, second)
            pair = np.repeat(np.add.reduceat(n, edge), _sizes(edge, len(n)))
            edge = _edges(first)
            begins = np.repeat(np.add.reduceat(n, edge), _sizes(edge, len(n)))
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)
                begins = np.where(frequent[at] == first, frequent_first[at], begins)
            seen = pair >= min_count
            value = np.where(seen, n * np.log(pair / np.maximum(begins, 1)), 0.0)
            known = np.zeros(len(n), bool)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, second), len(frequent) - 1)
                known = ~seen & (frequent[at] == second)
                value = np.where(known, n * np.log(backoff * frequent_n[at] / total), value)
            done = seen | known
            # One row of sums, and a row per partition of words to back off to.
            rest = np.flatnonzero(~done)
            rest = rest[np.lexsort((second[rest], code[rest]))]
            for b, mine in _by_bucket((second[rest] % np.uint64(buckets)).astype(np.int32)):
                mine = rest[mine]
                put(b, *_by_slice(names, code[mine]), _pack48(second[mine]), _pack_counts(n[mine]), b"")
            which, at = np.unique(code[done], return_inverse=True)
            put(own, *_by_slice(names, which), b"", np.bincount(at, value[done], len(which)).tobytes(), b"")
        return pd.DataFrame(dict(zip(["bucket", "slices", "per", "ref", "word", "n", "marks"], columns, strict=True)))

    def back(words: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows, slices, refs, values = [], [], [], []
        known = _unpack48(words["words"].iloc[0]) if len(words) else np.zeros(0, np.uint64)
        count = np.frombuffer(words["counts"].iloc[0], np.int64) if len(words) else np.zeros(0, np.int64)
        for names, per, ref, word, n, marks in zip(asked["slices"], asked["per"], asked["ref"], asked["word"], asked["n"], asked["marks"], strict=True):
            names = np.frombuffer(names, np.int64)
            if marks:
                rows.append((int(names[0]), b"", b"", marks))
                continue
            slices.append(np.repeat(names, _unpack_counts(per)))
            refs.append(np.frombuffer(ref, np.uint16).astype(np.int64))
            values.append(np.log(backoff * count[np.searchsorted(known, _unpack48(word))] / total) * _unpack_counts(n) if word else np.frombuffer(n, np.float64))
        if slices:
            names, at = np.unique(np.concatenate(slices), return_inverse=True)
            which, at = np.unique((at << 16) + np.concatenate(refs), return_inverse=True)
            sums = np.bincount(at, np.concatenate(values), len(which))
            edge = _edges(which >> 16)
            for a, size in zip(edge, _sizes(edge, len(which)), strict=True):
                rows.append((int(names[which[a] >> 16]), (which[a : a + size] & 65535).astype(np.uint16).tobytes(), sums[a : a + size].tobytes(), b""))
        return pd.DataFrame(rows, columns=["slice", "ref", "value", "marks"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        mark = np.frombuffer(next(m for m in pdf["marks"] if m), np.int64)
        value = np.zeros(len(mark))
        for ref, part in zip(pdf["ref"], pdf["value"], strict=True):
            value[np.frombuffer(ref, np.uint16)] += np.frombuffer(part, np.float64)
        return pd.DataFrame({"mark": mark, "value": value})

    pairs = texts.mapInArrow(send, "bucket int, slice long, marks binary, ref binary, first binary, runs binary, second binary, many binary, n binary")
    scored = pairs.groupBy("bucket").applyInPandas(score, "bucket int, slices binary, per binary, ref binary, word binary, n binary, marks binary")
    met = words.groupBy("bucket").cogroup(scored.groupBy("bucket")).applyInPandas(back, "slice long, ref binary, value binary, marks binary")
    # Repeated rows have equal texts and therefore equal sums.
    sums = met.groupBy("slice").applyInPandas(add, "mark long, value double").groupBy("mark").agg(F.max("value").alias("value"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column("text")):
                count = tx.Words(data, offsets).counts
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(low, high - low) for c in (0, 1)] + [pa.array(count.astype(np.int64))], ["doc_id", "_mark", "n_words"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_mark"), "text").mapInArrow(lengths, f"doc_id {kind}, _mark long, n_words long")
    return rows.join(sums, F.col("_mark") == sums["mark"], "left").select(
        "doc_id",
        "n_words",
        F.round(F.coalesce("value", F.lit(0.0)), 6).alias("log_score"),
        F.round(F.when(F.col("n_words") > 1, F.col("value") / (F.col("n_words") - 1)), 6).alias("score"),
    )


def _total(words: DataFrame) -> int:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(int(np.frombuffer(c.as_py(), np.int64).sum()) for c in batch.column("counts"))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return words.select("counts").mapInArrow(add, "n long").agg(F.sum("n")).first()[0] or 0
