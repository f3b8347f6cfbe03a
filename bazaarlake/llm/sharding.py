"""Jump consistent hashing of stable keys to shards, with gapless slots; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

# Fixed values of the published generator: key * 2862933555777941757 + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757
LIMB = 22
_MASK = (1 << LIMB) - 1
_M0, _M1, _M2 = MULTIPLIER & _MASK, (MULTIPLIER >> LIMB) & _MASK, MULTIPLIER >> (2 * LIMB)
ROWS_PER_FILE = 1_000_000
#: Offsets of so many files at most are broadcast, some 20 MB.
MAX_OFFSETS = 100_000


def _step(state: Column, shards: int) -> Column:
    """One jump, while the next shard is below ``shards``.

    The 64-bit key is held in three limbs of 22, 22 and 20 bits, so no product leaves a signed long.
    """
    k0, k1, k2 = state["k0"], state["k1"], state["k2"]
    r0 = k0 * _M0 + 1
    r1 = k0 * _M1 + k1 * _M0 + F.shiftright(r0, LIMB)
    r2 = k0 * _M2 + k1 * _M1 + k2 * _M0 + F.shiftright(r1, LIMB)
    n0, n1, n2 = r0.bitwiseAND(_MASK), r1.bitwiseAND(_MASK), r2.bitwiseAND((1 << 20) - 1)
    top = F.shiftleft(n2, 11) + F.shiftright(n1, 11) + 1
    jump = F.floor((state["next"] + 1).cast("double") * (F.lit(2147483648.0) / top.cast("double"))).cast("long")
    moved = F.struct(
        n0.alias("k0"), n1.alias("k1"), n2.alias("k2"), state["next"].alias("at"), jump.alias("next")
    )
    return F.when(state["next"] < shards, moved).otherwise(state)


def jump(key: Column, shards: int) -> Column:
    """Struct of ``at``, the shard of a long key among ``shards``, and ``next``, where a larger count sends it."""
    start = F.struct(
        key.bitwiseAND(_MASK).alias("k0"),
        F.shiftrightunsigned(key, LIMB).bitwiseAND(_MASK).alias("k1"),
        F.shiftrightunsigned(key, 2 * LIMB).bitwiseAND((1 << 20) - 1).alias("k2"),
        F.lit(-1).cast("long").alias("at"),
        F.lit(0).cast("long").alias("next"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, lambda state, _: _step(state, shards))


def shard_rows(df: DataFrame, key: str, shards: int) -> DataFrame:
    """``df`` with ``shard``, ``grown_shard`` (with one more shard) and ``slot``, gapless from 0 in each shard.

    The key and the shard count alone decide, so one more shard takes rows only into itself. An integer key
    is used as it is, any other by its 64-bit hash, a null one as 0; equal keys share a shard. Rows that are
    equal keep a slot each. An empty table gives no rows. Columns of these three names in ``df`` are replaced.

    Slots follow the order of the keys in a shard. The rows are written in ranges of shard and key, in files of
    bounded length; a row's slot is its place among its shard's rows in its file plus what earlier files
    hold. No window runs over a shard, and the rows of a hot key or shard spread over ranges: behind the key
    they are dealt out by the hash of the whole row and their place in the input.
    """
    kind = df.schema[key].dataType.typeName()
    number = df[key].cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(df[key])
    number = F.when(df[key].isNull(), F.lit(0).cast("long")).otherwise(number)
    names = [c for c in df.columns if c not in ("shard", "grown_shard", "slot")]
    # The row travels as one column, so that its names don't meet those used here.
    kept = df.select(
        F.struct(*[df[c] for c in names]).alias("row"),
        df[key].alias("key"),
        jump(number, shards).alias("j"),
        F.xxhash64(*[df[c] for c in names]).alias("hash"),
        F.monotonically_increasing_id().alias("at"),
    )
    grown = F.when(F.col("j.next") == shards, shards).otherwise(F.col("j.at")).cast("int")
    kept = kept.select("row", "key", F.col("j.at").cast("int").alias("shard"), grown.alias("grown_shard"), "hash", "at")
    order = ["shard", "key", "hash", "at"]
    ranged = kept.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "shard", "grown_shard")
    stored = store(ranged, "shards", maxRecordsPerFile=ROWS_PER_FILE)
    stored = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    held = store(stored.groupBy("shard", "file").agg(F.count("*").alias("n"), F.min("place").alias("first")), "held")
    before = Window.partitionBy("shard").orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("shard", "file", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One short row per shard and file; beyond the bound the rows are shuffled to them.
    if held.count() <= MAX_OFFSETS:
        offsets = F.broadcast(offsets)
    return stored.join(offsets, ["shard", "file"]).select(
        *[F.col("row")[c].alias(c) for c in names],
        "shard",
        "grown_shard",
        (F.col("place") - F.col("first") + F.col("before")).cast("long").alias("slot"),
    )
