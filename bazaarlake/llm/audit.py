"""Which documents each of several filters removes, for every order in which the filters can be applied.

A document's *mask* holds one bit per filter that it fails. Whatever happens to it in any order follows from the
mask: it is removed at the first step whose filter it fails, and is redundant for the later ones. So every mask is mapped to one
big integer with a field for each outcome of each step (five filters: 120 orders x 5 steps = 600 steps), and adding
integers counts all steps of all orders at once. A field is 64 bits wide: it counts documents at most once, so it can't carry
into the next before a part holds 2**64 of them. Documents with the same mask are counted first, by partial aggregates, and their
integer is added that many times, by one multiplication; a part then adds at most ``4 * 2**filters`` integers.

Defined cases: a null text is the empty text, a null ``lang`` the part ``''``. A document with a null doc_id has no
smaller one and is none, so it neither is nor makes a copy. Repeated rows count once each; equal ids with equal texts don't make each
other copies. Several labels of one id: one that says 1 is enough. Documents without labels lose nothing. Without documents there are no
parts. Columns beside those named are not read.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
#: Letters of the filters of documents; E, the copies, is judged over the whole table.
FILTERS = "ABCDE"

#: Fields of one step, from the lowest bits up.
FIELDS = ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8

OUTCOMES = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


# --- documents to masks ---------------------------------------------------------------------------


def _mask(fails: list[Column]) -> Column:
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return sum(bits[1:], bits[0]).cast("int")


def judged(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``part``, ``mark``, ``own``): digest of the text and mask of the filters that look at one text alone."""
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = texts.select("*", F.array_remove(F.split("text", SPACE), "").alias("words"))
    points = F.length("text")
    capitals = points - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    measured = split.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("mark"),
        F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("different"),
        points.alias("points"), capitals.alias("capitals"), F.col("text").rlike(SYMBOLS).alias("symbols"),
    )
    own = _mask(
        [
            F.col("n") < MIN_WORDS,
            100 * F.col("different").cast("long") < MIN_DISTINCT_PERCENT * F.col("n").cast("long"),
            100 * F.col("capitals").cast("long") > MAX_CAPITAL_PERCENT * F.col("points").cast("long"),
            F.col("symbols"),
        ]
    )
    return measured.select("doc_id", "part", "mark", own.alias("own"))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``part``, ``mask``, ``good``, ``toxic``) of every document.

    Texts are read once and leave as digests. Copies and labels come by joins of written tables on single keys, so that Spark
    splits a digest or a null id that holds very many rows; only digests with copies and ids with a label of 1 are joined.
    """
    rows = store(judged(docs), "judged")
    copied = rows.groupBy("mark").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copied = store(copied.select("mark", "first"), "copied")
    told = labels.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    told = store(told.where("good or toxic"), "told")
    no = F.lit(False)
    copy = F.when(F.coalesce(F.col("doc_id") > F.col("first"), no), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(copied, "mark", "left").join(told, "doc_id", "left").select(
        "part", (F.col("own") + copy).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )


# --- masks to packed counters ---------------------------------------------------------------------


@cache
def orders(filters: int) -> tuple[tuple[int, ...], ...]:
    """Every order of the filters, by number."""
    return tuple(permutations(range(filters)))


@cache
def packed(filters: int) -> dict[tuple[int, bool, bool], int]:
    """The integer of every (mask, good, toxic): all outcomes of all steps of all orders for one document."""
    out = {}
    for mask, good, toxic in product(range(1 << filters), (False, True), (False, True)):
        steps = np.zeros((len(orders(filters)), filters, len(FIELDS)), "<u8")
        for at, order in enumerate(orders(filters)):
            gone = False
            for step, letter in enumerate(order):
                if mask >> letter & 1:
                    lost = not gone
                    steps[at, step] = lost, gone, mask == 1 << letter, lost and good, lost and toxic
                    gone = True
        out[mask, good, toxic] = int.from_bytes(steps.tobytes(), "little")
    return out


def unpack(total: int, filters: int) -> np.ndarray:
    """The fields of a sum: orders x steps x outcomes."""
    shape = (len(orders(filters)), filters, len(FIELDS))
    return np.frombuffer(total.to_bytes(FIELD_BYTES * int(np.prod(shape)), "little"), "<u8").reshape(shape).astype(np.int64)


def audit(masks: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from (``part``, ``mask``, ``good``, ``toxic``) of each document.

    Bit ``i`` of a mask stands for ``letters[i]``. A part reaches its task as one count per mask and label.
    """
    filters = len(letters)
    names = ["".join(letters[i] for i in order) for order in orders(filters)]

    def add_up(counts: pd.DataFrame) -> pd.DataFrame:
        integers = packed(filters)
        total = 0
        for mask, good, toxic, n in zip(counts["mask"], counts["good"], counts["toxic"], counts["n"], strict=True):
            total += int(n) * integers[int(mask), bool(good), bool(toxic)]
        fields = unpack(total, filters)
        removed = fields[:, :, FIELDS.index("removed")]
        by_filter = np.zeros(filters, np.int64)
        np.add.at(by_filter, np.array(orders(filters)).ravel(), removed.ravel())
        out = {
            "part": counts["part"].iloc[0],
            "filter_order": np.repeat(names, filters),
            "step": np.tile(np.arange(1, filters + 1, dtype=np.int32), len(names)),
            "kept": (int(counts["n"].sum()) - np.cumsum(removed, axis=1)).ravel(),
        }
        out |= {name: fields[:, :, i].ravel() for i, name in enumerate(FIELDS)}
        out["shapley"] = by_filter[np.array(orders(filters)).ravel()]
        return pd.DataFrame(out)

    counted = masks.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("part").applyInPandas(add_up, OUTCOMES)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of ``FILTERS`` over whole documents, per language."""
    return audit(masked(docs, labels))
