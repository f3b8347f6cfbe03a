"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other. Three small transducers read
the symbols of a clause from left to right: one remembers a negation for a few words, one remembers reported
speech to the end of the clause, one remembers a target. Their composition is the product of the three
memories; on an insult or threat it writes the reading of the match (aimed, plain, negated, reported, threat)
with the word's weight. A text's score is a logistic function of the weights written per reading.

Which words and word beginnings insult or threaten is learned from a bounded sample of labelled texts, next
to a short fixed list; so are the weights of the readings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import text as tx
from bazaarlake.llm.labels import SAMPLE_ROWS, labelled, remainder
from bazaarlake.llm.storage import store

# Words of the grammar in the four languages of the corpus.
INSULTS = "idiot idiots moron morons stupid scum loser losers trash worthless pathetic disgusting imbecile bastard arschloch dummkopf abschaum hurensohn connard salaud abruti imbécile idiota estúpido basura imbécil".split()
THREATS = "kill murder hurt destroy beat töten umbringen vernichten tuer frapper matar golpear".split()
TARGETS = "you your yours he she they him her them du dich dir dein sie ihr tu toi te vous ton tes él ella usted ustedes vosotros".split()
NEGATIONS = "not no never neither nor nicht kein keine nie ne pas jamais nunca jamás ni".split()
REPORTS = "said says wrote writes claimed quoted called reported sagte schrieb nannte behauptete dit écrit appelé dijo escribió llamó".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
READINGS = ("aimed", "plain", "negated", "reported", "threat")
REACH = 4
PREFIXES = (4, 5, 6)
FIXED_WEIGHT = 3.0
WEIGHT_RANGE = (1.0, 5.0)
TEST_BUCKETS = 5

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), ord("'"), *range(128, 256)]] = False
_CLAUSE = np.zeros(256, bool)
_CLAUSE[[ord(c) for c in ".!?;:\n"]] = True


def word_hash(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    offsets = np.cumsum([0, *map(len, data)])
    return tx.Words(np.frombuffer(b"".join(data), np.uint8), offsets, between=_BETWEEN).hash


def _terms(words: tx.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, term) of whole words, then of the beginnings of longer ones, a family for each size."""
    yield np.arange(len(words.hash)), words.hash
    for size in PREFIXES:
        at = np.flatnonzero(words.end - words.start > size)
        yield at, words.part(words.start[at], words.start[at] + size) + np.uint64(size)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("y").to_numpy()
        for low, high, data, offsets in tx.slices(batch.column("text")):
            words = tx.Words(data, offsets, between=_BETWEEN)
            for family, (at, term) in enumerate(_terms(words)):
                rows, terms = tx.distinct(words.row[at], term)
                value, which = np.unique(terms, return_inverse=True)
                toxic = np.bincount(which, y[low:high][rows], len(value)).astype(np.int64)
                every = np.bincount(which, minlength=len(value)).astype(np.int64)
                of = np.full(len(value), family, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(value.view(np.int64)), pa.array(toxic), pa.array(every)], ["family", "term", "toxic", "docs"])


def learn_terms(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Terms that mark toxic texts, and their weights.

    A term's evidence is its log-likelihood ratio; it must pass what chance gives the best of its family about once.
    """
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    positive, negative = int(size.p), int(size.n - size.p)
    if not positive or not negative:
        return np.zeros(0, np.uint64), np.zeros(0)
    counted = store(sample.mapInArrow(_count_terms, "family int, term long, toxic long, docs long").groupBy("family", "term").agg(F.sum("toxic").alias("a"), F.sum("docs").alias("n")), "terms")
    bars = {r["family"]: 2 * float(np.log(max(r["count"], 2))) for r in counted.groupBy("family").count().collect()}
    bar = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(bars.items()) for x in pair]), F.col("family")) if bars else F.lit(0.0)
    rate = positive / (positive + negative)
    a, b = F.col("a"), F.col("n") - F.col("a")
    log = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    evidence = 2 * (log(a, F.col("n") * rate) + log(b, F.col("n") * (1 - rate)))
    weight = F.log((a + 0.5) / (positive + 1.0)) - F.log((b + 0.5) / (negative + 1.0))
    # At most one in the sample's words times docs can pass, as the sample is bounded.
    rows = counted.where((evidence > bar) & (weight > 2.5)).select("term", weight.alias("w")).orderBy("term").collect()
    return np.array([r.term for r in rows], np.int64).view(np.uint64), np.array([r.w for r in rows], float)


class Grammar:
    """The word classes and weights, and the composed transducer."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray):
        table: dict[int, tuple[int, float]] = {}
        for kind, names in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS)):
            table.update(dict.fromkeys(map(int, word_hash(names)), (kind, 0.0)))
        for kind, names in ((THREAT, THREATS), (INSULT, INSULTS)):
            table.update(dict.fromkeys(map(int, word_hash(names)), (kind, FIXED_WEIGHT)))
        for term, weight in zip(terms.tolist(), weights.tolist(), strict=True):
            kind = table.get(term, (INSULT, 0.0))[0]
            table[term] = (THREAT if kind == THREAT else INSULT, float(np.clip(weight, *WEIGHT_RANGE)))
        self.terms = np.array(sorted(table), np.uint64)
        self.kind = np.array([table[t][0] for t in self.terms.tolist()], np.int8)
        self.weight = np.array([table[t][1] for t in self.terms.tolist()])
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def symbols(self, words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of each word; of several terms an insult or threat of most weight counts."""
        kind, weight = np.zeros(len(words.hash), np.int8), np.zeros(len(words.hash))
        for at, term in _terms(words):
            maybe = np.flatnonzero(self.seen[(term >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.terms, term[maybe]), len(self.terms) - 1)
            hit = self.terms[place] == term[maybe]
            at, place = at[maybe[hit]], place[hit]
            better = (self.weight[place] > weight[at]) | (kind[at] == OTHER)
            kind[at[better]], weight[at[better]] = self.kind[place[better]], self.weight[place[better]]
        return kind, weight

    @staticmethod
    def read(kinds: list[int], weights: list[float]) -> Iterator[tuple[int, float]]:
        """The composed transducer over one clause: (reading, weight) of each match."""
        negated = aimed = 0
        reported = False
        for i, kind in enumerate(kinds):
            if kind == NEGATION:
                negated = REACH
            elif kind == REPORT:
                reported = True
            elif kind == TARGET:
                aimed = REACH
            elif kind in (INSULT, THREAT):
                near = aimed > 0 or TARGET in kinds[i + 1 : i + 1 + REACH]
                if reported:
                    yield 3, weights[i]
                elif negated > 0:
                    yield 2, weights[i]
                elif kind == THREAT:
                    # A threat needs someone it is aimed at.
                    if near:
                        yield 4, weights[i]
                else:
                    yield (0 if near else 1), weights[i]
            negated, aimed = negated - 1, aimed - 1

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Weight per reading of each text of a slice."""
        words = tx.Words(data, offsets, between=_BETWEEN)
        kind, weight = self.symbols(words)
        out = np.zeros((len(offsets) - 1, len(READINGS)))
        hits = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        if len(hits):
            clause = np.cumsum(_CLAUSE[data])[words.start] + words.row * np.int64(1)
            # A clause ends at its mark or with its text; both counts only grow, so their sum tells clauses apart.
            for c in np.unique(clause[hits]):
                low, high = np.searchsorted(clause, c, "left"), np.searchsorted(clause, c, "right")
                for reading, w in self.read(kind[low:high].tolist(), weight[low:high].tolist()):
                    out[words.row[low], reading] += w
        return np.log1p(out)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and bias by Newton steps; readings can't count against toxicity."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        grad = x1.T @ (p - y) + ridge * beta
        hess = (x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        beta[:-1] = np.maximum(beta[:-1], 0.0)
    return beta


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Grammar, np.ndarray]:
    """Grammar and reading weights from at most ``rows`` labelled texts; without labels fixed words and weights."""
    sample = store(labelled(docs, labels, "toxic", remainder(F.col("doc_id"), TEST_BUCKETS) != 0, rows), "toxic-sample")
    grammar = Grammar(*learn_terms(sample))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y")
            for low, high, data, offsets in tx.slices(batch.column("text")):
                x = grammar.features(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T] + [y.slice(low, high - low)], [*READINGS, "y"])

    seen = sample.mapInArrow(read, ", ".join(f"{r} double" for r in READINGS) + ", y int").toPandas()
    y = seen["y"].to_numpy(float)
    if len(set(y)) < 2:
        return grammar, np.array([2.0, 2.0, 0.3, 0.3, 2.0, -2.0])
    return grammar, fit_logistic(seen[list(READINGS)].to_numpy(float), y)


def score(docs: DataFrame, model: tuple[Grammar, np.ndarray], keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every document with ``score`` from 0 to 1; a null text counts as empty."""
    grammar, beta = model
    held = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"))
    schema = held.drop("_text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(batch.num_columns - 1)):
                logit = np.hstack([grammar.features(data, offsets), np.ones((high - low, 1))]) @ beta
                value = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                kept = [batch.column(i).slice(low, high - low) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(value)], schema.names)

    return held.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias("toxicity"))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    Labels of held-out ids (and null ids) are never learned from. Texts of any length are read whole; empty and
    null texts get the score of a text without matches; equal texts get equal scores; an empty table gives no
    rows. Only doc_id and text of ``docs`` are read, so other columns may have any name.
    """
    return score(docs, learn(docs, labels, rows), ["doc_id"]).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), TEST_BUCKETS) == 0, F.lit(True)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents whose score is below 0.5, with all their columns."""
    scored = score(docs, learn(docs, labels, rows), docs.columns)
    return scored.where("toxicity < 0.5").select(*docs.columns)
