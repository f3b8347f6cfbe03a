"""Mixing sources to target weights: hash-random order, prefix sums, one cut per source; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

KEY_BITS = 60
BUCKET_BITS = 12
MAX_SOURCES = 100_000
MAX_EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(key: Column, seed: str = "mix") -> Column:
    """A number below 2**60 that depends on the key and the seed alone."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(totals: DataFrame, share: float, weights: tuple[float, ...]) -> DataFrame:
    """``source``, ``total`` with ``target``: ``share`` of all sizes dealt by weight, at most ``MAX_EPOCHS`` times a source.

    Sources take the weights in turn, by code point, null last. What a full source can't take goes to the
    others by weight. With sources in the order of their limit per weight the full ones come first, so
    running sums give the level at which the rest share, without rounds. The table has one row per source.
    """
    named = totals.select(
        "source", "total", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("_i")
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_i") - 1) % len(weights) + 1).cast("int"))
    limit = F.col("total") * F.lit(float(MAX_EPOCHS))
    sized = named.select("source", "total", "_i", weight.alias("_w"), limit.alias("_limit"))
    order = [F.col("_limit") / F.col("_w"), F.col("_i")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("total").over(every) * share - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    leveled = sized.withColumn("_level", level).withColumn("_full", F.col("_limit") <= F.col("_level") * F.col("_w"))
    # The first source that isn't full sets the level of all that follow.
    open_level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(every)
    return leveled.select(
        "source", "total", F.when(F.col("_full"), F.col("_limit")).otherwise(open_level * F.col("_w")).alias("target")
    )


def _small(sources: DataFrame):
    """How to join tables of one row per source: broadcast for at most ``MAX_SOURCES`` of them, by a shuffle beyond."""
    return F.broadcast if sources.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES else (lambda df: df)


def _kept(plan: DataFrame) -> DataFrame:
    plan = store(plan, "mix-plan").withColumnRenamed("source", "_source")
    return _small(plan)(plan)


def plan_mix(rows: DataFrame, share: float, weights: tuple[float, ...]) -> DataFrame:
    """One row per source: what to take of rows with ``source``, ``size`` and ``key``.

    A source repeats ``epochs`` whole times; of the last, partial epoch it takes keys below ``cut`` whole,
    keys equal to it by ``left`` / ``at_cut`` of their size, none above. Sizes are summed per source and key
    range first; only the range in which the budget ends is summed key by key.
    """
    bucket = F.shiftright("key", KEY_BITS - BUCKET_BITS)
    ranges = store(rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-ranges")
    totals = ranges.groupBy("source").agg(F.sum("words").alias("total"))
    goal = store(
        targets(totals, share, weights).withColumns(
            {
                "epochs": F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long"),
                "budget": F.when(F.col("total") > 0, F.floor(F.col("target"))).otherwise(0).cast("long"),
            }
        ).withColumn("budget", F.col("budget") - F.col("epochs") * F.col("total")),
        "mix-targets",
    )
    small = _small(goal)
    goal = small(goal)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        ranges.withColumn("_upto", F.sum("words").over(running))
        .join(goal, ranges["source"].eqNullSafe(goal["source"]))
        .where((F.col("_upto") > F.col("budget")) & (F.col("_upto") - F.col("words") <= F.col("budget")))
        .select(ranges["source"].alias("_s"), F.col("bucket").alias("_b"), (F.col("budget") - F.col("_upto") + F.col("words")).alias("_rest"))
    )
    found = small(found)
    sums = (
        rows.join(found, rows["source"].eqNullSafe(found["_s"]) & (bucket == found["_b"]))
        .groupBy("source", "key")
        .agg(F.sum("size").alias("words"), F.first("_rest").alias("_rest"))
    )
    by_key = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        sums.withColumn("_upto", F.sum("words").over(by_key))
        .where((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("words") <= F.col("_rest")))
        .select(F.col("source").alias("_s"), F.col("key").alias("cut"), F.col("words").alias("at_cut"), (F.col("_rest") - F.col("_upto") + F.col("words")).alias("left"))
    )
    return goal.join(small(cuts), goal["source"].eqNullSafe(F.col("_s")), "left").select(
        goal["source"], "total", "target", "epochs", "cut", "at_cut", "left"
    )


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with ``source``, ``size``, ``key``) with ``source_size``, ``target`` and ``taken`` words."""
    plan = _kept(plan)
    last = (
        F.when(F.col("key") < F.col("cut"), F.col("size"))
        .when(F.col("key") == F.col("cut"), F.floor(F.col("size") * F.col("left") / F.col("at_cut")))
        .otherwise(0)
    )
    taken = F.col("epochs") * F.col("size") + F.when(F.col("cut").isNull(), 0).otherwise(last)
    return rows.join(plan, rows["source"].eqNullSafe(plan["_source"])).select(
        *rows.columns, F.col("total").alias("source_size"), "target", taken.cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``source``, ``key`` of every document.

    ``taken`` counts the words the mix takes of the document, repeats included: whole epochs plus, in the
    last one, what lies before the source's cut; the document at the cut gives the words up to it. Documents
    come in the order of a hash of doc_id, so reruns agree. A null text has size 0, a null source is a source
    of its own (last), rows of one doc_id share the words at the cut by size, an empty table gives no rows.
    """
    rows = store(
        docs.select("doc_id", word_count(docs["text"]).alias("size"), random_key(docs["doc_id"]).alias("key"), "source"), "mix-rows"
    )
    return take(rows, plan_mix(rows, share, weights))


def draw_mix(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """The mixed documents with the columns of ``docs``: one row per epoch that takes the document.

    Texts stay whole, so the document at a source's cut is taken as a whole. One map over the texts: the cut of
    its source alone decides on a document. Documents without words are taken with the epochs of their source.
    """
    names = docs.columns
    held = docs.select(F.struct(*names).alias("_doc"), "source", word_count(docs["text"]).alias("size"), random_key(docs["doc_id"]).alias("key"))
    plan = plan_mix(store(held.select("source", "size", "key"), "mix-rows"), share, weights)
    plan = _kept(plan)
    partial = F.col("cut").isNotNull() & ((F.col("key") < F.col("cut")) | ((F.col("key") == F.col("cut")) & (F.col("left") > 0)))
    times = (F.col("epochs") + F.when(partial, 1).otherwise(0)).cast("int")
    times = F.when(F.col("total") > 0, times).otherwise(1)
    return (
        held.join(plan, held["source"].eqNullSafe(plan["_source"]))
        .where(times > 0)
        .select("_doc", F.explode(F.sequence(F.lit(1), times)))
        .select(*[F.col("_doc")[c].alias(c) for c in names])
    )
