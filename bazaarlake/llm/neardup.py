"""Near duplicates among embeddings: lattice hashing in several tables, neighbouring cells, exact cosines.

Equal vectors share a node. Nodes within ``BALL`` of a common centre form a *ball*: any two of them have a cosine above the
threshold, so a ball of a million near copies is one class that needs no pair of its own; balls are found in bounded chunks of
lattice cells, over and over, and the centres of grown balls are brought together in turn.

In every table a vector is projected on random directions, eight at a time, and decoded to the nearest point of the E8 lattice; the
points of all blocks name its cell. Each node is filed under its own cell and asks there and in the neighbouring cells it is
closest to, so pairs that a cell border parts are found too. The number of blocks follows the number of nodes, and the number of tables the
chance, measured on random pairs exactly at the threshold, that one table finds a pair: together they find it with
probability ``FOUND`` or more. Two balls that meet in a cell are a candidate if the signs of ``SIGNS`` random directions, six standard
deviations allowed, don't rule it out. Candidates are decided by exact cosines in double precision: of two single nodes by their own; of balls by the
triangle inequality where it tells, and member by member, in blocks, where it doesn't. Links are counted per node and never listed
within a ball; between two balls at most one stands for all in the components.

Defined cases: vectors that are null, empty, zero or hold null or non-finite entries link with nothing, nor do rows without ``vec_id``, whose component is
null and which aren't kept. Vectors of different length don't link. Repeated rows are different vectors that link. Columns beside the two named
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.components import components
from bazaarlake.llm.storage import store, tasks_for

THRESHOLD = 0.9
#: Cosine of a ball's members to its centre: twice this angle stays within the threshold's.
BALL = 0.975
#: Probability that a pair exactly at the threshold meets in some table.
FOUND = 0.97
#: Size of a lattice cell against the length of unit vectors' projections, and neighbouring cells asked.
WIDTH, NEIGHBOURS = 1.8, 8
#: Blocks of eight dimensions are added until a node shares its cells with about so many others by chance.
CHANCE_MEETINGS = 4096
LEAST_BLOCKS = 2
#: Chunks in which balls are sought, and the rounds of it; rounds save work and decide nothing.
CHUNK, ROUNDS = 2048, 6
MEMBERS = 512
SIGNS = 128
_SEED = 20_813
_SLACK = 1e-9


# --- the lattice ----------------------------------------------------------------------------------


def _even(y: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    rest = (y - near)[odd]
    worst = np.abs(rest).argmax(axis=1)
    near[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest point of E8 of every row of eight: integers of even sum, or all halves of such."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    return np.where((((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1))[:, None], whole, half)


@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the neighbouring cells."""
    whole = [v for v in product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    half = [v for v in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half, float)


def _names(points: np.ndarray, table: int, block: int) -> np.ndarray:
    """64-bit names of lattice points (last axis: eight coordinates, in halves)."""
    odd = np.random.default_rng([_SEED, table, block, 1]).integers(1 << 62, size=8, dtype=np.int64) * 2 + 1
    with np.errstate(over="ignore"):
        name = (np.rint(points * 2).astype(np.int64) * odd).sum(axis=-1)
        name ^= (name.view(np.uint64) >> np.uint64(29)).view(np.int64)
        return name * np.int64(-0x61C8864680B583EB)


def cells(y: np.ndarray, table: int, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Names of the own cell and of the nearest neighbouring cells (rows x 1 + ``neighbours``) of projections ``y`` (rows x blocks x 8).

    Of all combinations of the blocks' own and neighbouring points those come first that lie least farther away.
    """
    rows, blocks, _ = y.shape
    names, extra = np.zeros((rows, 1), np.int64), np.zeros((rows, 1))
    for block in range(blocks):
        own = decode(y[:, block])
        farther = 2 - 2 * (y[:, block] - own) @ shortest().T
        pick = np.argpartition(farther, neighbours - 1, axis=1)[:, :neighbours] if neighbours else np.zeros((rows, 0), int)
        points = np.concatenate([own[:, None], own[:, None] + shortest()[pick]], axis=1)
        cost = np.concatenate([np.zeros((rows, 1)), np.take_along_axis(farther, pick, 1)], axis=1)
        extra = (extra[:, :, None] + cost[:, None, :]).reshape(rows, -1)
        with np.errstate(over="ignore"):
            names = (names[:, :, None] * np.int64(0x100000001B3) + _names(points, table, block)[:, None, :]).reshape(rows, -1)
        least = np.argsort(extra, axis=1, kind="stable")[:, : neighbours + 1]
        names, extra = np.take_along_axis(names, least, 1), np.take_along_axis(extra, least, 1)
    return names


@cache
def _directions(length: int, table: int, blocks: int) -> np.ndarray:
    return np.random.default_rng([_SEED, table, length]).normal(size=(length, blocks, 8))


def projected(unit: np.ndarray, table: int, blocks: int, width: float = WIDTH) -> np.ndarray:
    return np.einsum("nd,dbk->nbk", unit, _directions(unit.shape[1], table, blocks), optimize=True) / width


@cache
def layout(nodes: int, chance_meetings: int = CHANCE_MEETINGS) -> tuple[int, int]:
    """(blocks, tables) for so many nodes.

    Two unrelated vectors share a cell of one block with the chance that two normal points of eight dimensions do. The chance that a table
    finds a pair at the threshold depends on the angle alone, so made-up pairs of a fixed number measure it.
    """
    share = (WIDTH / (2 * math.sqrt(math.pi))) ** 8
    blocks = LEAST_BLOCKS
    while True:
        rng = np.random.default_rng([_SEED, blocks])
        a = rng.normal(size=(4000, blocks, 8))
        b = THRESHOLD * a + math.sqrt(1 - THRESHOLD**2) * rng.normal(size=a.shape)
        own, other = cells(a / WIDTH, 0), cells(b / WIDTH, 0)
        met = (own == other[:, :1]).any(axis=1) | (other == own[:, :1]).any(axis=1)
        tables = math.ceil(math.log(1 - FOUND) / math.log(1 - float(met.mean())))
        if nodes * tables * (1 + NEIGHBOURS) * 2 * share**blocks <= chance_meetings:
            return blocks, tables
        blocks += 1


# --- vectors in tasks -----------------------------------------------------------------------------


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each length among the vectors of a column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        part = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), length)
        part = part / np.abs(part).max(axis=1, keepdims=True)
        yield rows, part / np.sqrt((part * part).sum(axis=1, keepdims=True))


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable() -> Column:
    entries = F.col("embedding")

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    sound = (F.size(entries) > 0) & F.forall(entries, finite) & F.exists(entries, lambda c: c != 0)
    return F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))


# --- balls ----------------------------------------------------------------------------------------


def _lead(group: pd.DataFrame) -> pd.DataFrame:
    """(``ball``, ``lead``, ``vector``): centres of a chunk that join an earlier one of it."""
    group = group.sort_values("ball", ignore_index=True)
    out_ball, out_lead = [], []
    sizes = group["vector"].map(len)
    for length in sizes.unique():
        part = group[sizes == length]
        unit = _unit(part["vector"])
        near = unit @ unit.T >= BALL
        free = np.ones(len(part), bool)
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            if free[i]:
                joins = near[i] & free
                free[i] = False
                joins[i] = False
                free &= ~joins
                out_ball += list(part.index[joins])
                out_lead += [part.index[i]] * int(joins.sum())
    chosen = group.loc[out_lead]
    return pd.DataFrame({"ball": group["ball"].loc[out_ball].to_numpy(), "lead": chosen["ball"].to_numpy(), "vector": chosen["vector"].to_numpy()})


def _own_cells(centres: DataFrame, table: int) -> DataFrame:
    """``centres`` with the ``cell`` of one block."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch), np.int64)
            for rows, unit in _by_length(batch.column(1)):
                out[rows] = cells(projected(unit, table, 1), table, 0)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "cell"])

    kind = dict(centres.dtypes)["vector"]
    return centres.select("ball", "vector").mapInArrow(name, f"ball long, vector {kind}, cell long")


def balls(nodes: DataFrame) -> DataFrame:
    """(``node``, ``n``, ``vector``, ``ball``, ``cosine``, ``centre``): every node with its ball, whose centre is a node's vector.

    The first round looks at all nodes, the later ones at the centres of balls that have grown, each in the cells of another table, dealt
    to chunks by chance. A node moves to a centre's new centre only if it lies within ``BALL`` of that itself.
    """
    spark = nodes.sparkSession
    current = nodes.select("node", "n", "vector", F.col("node").alias("ball"), F.lit(1.0).alias("cosine"), F.col("vector").alias("centre"))
    centres = nodes.select(F.col("node").alias("ball"), "vector")
    for table in range(ROUNDS):
        placed = store(_own_cells(centres, 1000 + table), "placed")
        total = placed.count()
        if total < 2:
            break
        crowded = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        crowded = crowded.select("cell", F.ceil(F.col("m") / CHUNK).alias("chunks"))
        dealt = placed.join(store(crowded, "crowded"), "cell").withColumn("chunk", F.pmod(F.xxhash64("ball", F.lit(table)), "chunks"))
        dealt = dealt.repartition(tasks_for(spark, total, CHUNK), "cell", "chunk")
        moves = store(dealt.groupBy("cell", "chunk").applyInPandas(_lead, f"ball long, lead long, vector {dict(placed.dtypes)['vector']}"), "moves")
        if moves.isEmpty():
            break
        current = store(_moved(current, moves), "balls")
        grown = current.groupBy("ball").agg(F.count(F.lit(1)).alias("m"), F.any_value("centre").alias("vector")).where("m > 1")
        centres = grown.select("ball", "vector")
    return current


def _moved(current: DataFrame, moves: DataFrame) -> DataFrame:
    """Nodes whose ball's centre joins another one, moved where they are close enough to it."""
    kind = dict(current.dtypes)["vector"]
    joined = current.join(moves.select("ball", "lead", F.col("vector").alias("to")), "ball", "left")
    joined = joined.select("node", "n", "vector", "ball", "cosine", "centre", "lead", "to")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball, lead = batch.column(3).to_numpy().copy(), batch.column(6)
            cosine, stay = batch.column(4).to_numpy().copy(), np.ones(len(batch), bool)
            asked = np.flatnonzero(lead.is_valid().to_numpy(zero_copy_only=False))
            if len(asked):
                some = batch.take(pa.array(asked))
                for rows, unit in _by_length(some.column(2)):
                    ((_, target),) = _by_length(some.column(7).take(pa.array(rows)))
                    c = np.einsum("ij,ij->i", unit, target)
                    ok = c >= BALL
                    at = asked[rows[ok]]
                    ball[at] = some.column(6).to_numpy()[rows[ok]]
                    cosine[at], stay[at] = c[ok], False
            centre = pa.concat_arrays([batch.column(5), batch.column(7)]).take(pa.array(np.arange(len(batch)) + np.where(stay, 0, len(batch))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(ball), pa.array(cosine), centre],
                ["node", "n", "vector", "ball", "cosine", "centre"],
            )

    return joined.mapInArrow(move, f"node long, n long, vector {kind}, ball long, cosine double, centre {kind}")


# --- candidates -----------------------------------------------------------------------------------


def _filed(current: DataFrame, blocks: int, tables: int) -> DataFrame:
    """(``cell``, ``own``, ``ball``, ``s0``, ``s1``, ``reach``): every cell that a node stands in or asks, with its ball's signs."""

    def sign_words(unit: np.ndarray) -> np.ndarray:
        directions = np.random.default_rng([_SEED, unit.shape[1], 2]).normal(size=(unit.shape[1], SIGNS))
        return np.packbits(unit @ directions >= 0, axis=1).view(np.int64)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), 2048):
                batch = whole.slice(low, 2048)
                for rows, unit in _by_length(batch.column(1)):
                    ((_, centre),) = _by_length(batch.column(2).take(pa.array(rows)))
                    signs = sign_words(centre)
                    ball, reach = (batch.column(c).to_numpy()[rows] for c in (0, 3))
                    for table in range(tables):
                        names = cells(projected(unit, table, blocks), table)
                        many = names.shape[1]
                        held = {"ball": ball, "s0": signs[:, 0], "s1": signs[:, 1], "reach": reach}
                        frame = {"cell": names.ravel() + np.int64(unit.shape[1]), "own": np.tile(np.arange(many) == 0, len(rows))}
                        yield pa.RecordBatch.from_pydict(frame | {k: np.repeat(v, many) for k, v in held.items()})

    rows = current.select("ball", "vector", "centre", "reach")
    return rows.mapInArrow(file, "cell long, own boolean, ball long, s0 long, s1 long, reach double")


def candidates(current: DataFrame, blocks: int, tables: int) -> DataFrame:
    """(``a``, ``b``) of balls that meet in a cell of some table and whose signs allow a link, once each.

    All nodes of a ball that share a cell are one entry of it. The join is an equi-join of two exchanges, so
    Spark splits a cell that very many balls share.
    """
    grown = _filed(current.where("m > 1"), blocks, tables)
    grown = grown.groupBy("cell", "ball", "s0", "s1", "reach").agg(F.max("own").alias("own"))
    filed = store(_filed(current.where("m = 1"), blocks, tables).unionByName(grown), "filed")
    own, asks = filed.where("own").alias("own"), filed.alias("asks")
    # The angle that two centres may have, as a share of signs, six standard deviations allowed.
    share = F.least(F.lit(1.0), (F.lit(math.acos(THRESHOLD)) + F.col("own.reach") + F.col("asks.reach")) / math.pi)
    most = SIGNS * share + 6 * F.sqrt(SIGNS * share * (1 - share))
    differ = F.bit_count(F.col("own.s0").bitwiseXOR(F.col("asks.s0"))) + F.bit_count(F.col("own.s1").bitwiseXOR(F.col("asks.s1")))
    met = own.join(asks, (F.col("own.cell") == F.col("asks.cell")) & (F.col("own.ball") != F.col("asks.ball")) & (differ <= most))
    pairs = met.select(F.least("own.ball", "asks.ball").alias("a"), F.greatest("own.ball", "asks.ball").alias("b"))
    return pairs.distinct()


# --- links ----------------------------------------------------------------------------------------


def _judged(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """``pairs`` with both balls' rows ``n`` and ``verdict``: 1 all their nodes link, 0 none does, null where members must be asked."""

    def side(name: str) -> DataFrame:
        return heads.select(F.col("ball").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("m", "n", "reach", "centre")])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    columns = ["a", "b", "n_a", "n_b", "m_a", "m_b", "reach_a", "reach_b", "centre_a", "centre_b"]
    limit = math.acos(THRESHOLD)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.zeros(len(batch))
            equal = batch.column(8).value_lengths().to_numpy() == batch.column(9).value_lengths().to_numpy()
            some = batch.filter(pa.array(equal))
            place = np.flatnonzero(equal)
            for rows, one in _by_length(some.column(8)):
                ((_, other),) = _by_length(some.column(9).take(pa.array(rows)))
                cosine[place[rows]] = np.einsum("ij,ij->i", one, other)
            m_a, m_b, reach_a, reach_b = (batch.column(c).to_numpy() for c in (4, 5, 6, 7))
            angle = np.arccos(np.clip(cosine, -1, 1))
            sure = angle + reach_a + reach_b + _SLACK <= limit
            never = angle - reach_a - reach_b - _SLACK > limit
            single = (m_a == 1) & (m_b == 1)
            verdict = np.where(single, cosine >= THRESHOLD, sure).astype(np.int32)
            unknown = ~single & ~sure & ~never & equal
            out = pa.array(np.where(equal, verdict, 0).astype(np.int32), mask=unknown)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], out], ["a", "b", "n_a", "n_b", "verdict"])

    return both.select(*columns).mapInArrow(judge, "a long, b long, n_a long, n_b long, verdict int")


def _asked(open_pairs: DataFrame, current: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``node``, ``links``) of the members of two balls that link across, by products of blocks of members."""
    spark = current.sparkSession
    wanted = open_pairs.select(F.col("a").alias("ball")).union(open_pairs.select(F.col("b").alias("ball"))).distinct()
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / MEMBERS))
    members = current.join(wanted, "ball", "left_semi").groupBy("ball", part.alias("part"))
    members = members.agg(*[F.collect_list(c).alias(c) for c in ("node", "n", "vector")])
    members = store(members.drop("part"), "members")

    def side(name: str) -> DataFrame:
        return members.select(F.col("ball").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("node", "n", "vector")])

    both = open_pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                a, b, node_a, n_a, vector_a, node_b, n_b, vector_b = (c[row : row + 1] for c in batch.columns)
                ((_, one),), ((_, other),) = _by_length(vector_a.flatten()), _by_length(vector_b.flatten())
                linked = one @ other.T >= THRESHOLD
                weight_a, weight_b = n_a.flatten().to_numpy(), n_b.flatten().to_numpy()
                nodes = np.concatenate([node_a.flatten().to_numpy(), node_b.flatten().to_numpy()])
                links = np.concatenate([linked @ weight_b, weight_a @ linked])
                some = links > 0
                many = int(some.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(many, a[0].as_py())), pa.array(np.full(many, b[0].as_py())), pa.array(nodes[some]), pa.array(links[some])],
                    ["a", "b", "node", "links"],
                )

    columns = ["a", "b", "node_a", "n_a", "vector_a", "node_b", "n_b", "vector_b"]
    # Each row holds two blocks of members, so a task takes few of them at a time.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    try:
        return store(both.select(*columns).mapInArrow(ask, "a long, b long, node long, links long"), "asked")
    finally:
        spark.conf.set(name, before)


def near_duplicates(vectors: DataFrame, chance_meetings: int = CHANCE_MEETINGS) -> DataFrame:
    """(``vec_id``, ``n_links``, ``component_id``, ``kept``) of every row of ``vectors`` (``vec_id``, ``embedding``)."""
    entries = F.col("embedding").cast("array<double>")
    read = vectors.select("vec_id", entries.alias("embedding"))
    read = read.select("vec_id", "embedding", _usable().alias("usable"))
    # Two independent hashes name a vector; -0.0 and 0.0 hash alike.
    names = [F.when(F.col("usable"), F.xxhash64(F.lit(seed), "embedding")).alias(f"h{seed}") for seed in (0, 1)]
    read = read.select("vec_id", *names, "embedding")
    ids = store(read.select("vec_id", "h0", "h1"), "ids")
    nodes = read.where("h0 is not null").groupBy("h0", "h1")
    nodes = nodes.agg(F.any_value("embedding").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    nodes = store(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    current = balls(nodes)
    sizes = current.groupBy("ball").agg(F.count(F.lit(1)).alias("m"), F.min("cosine").alias("cosine"))
    grown = store(sizes.where("m > 1"), "grown")
    current = current.withColumnRenamed("cosine", "own_cosine").join(grown, "ball", "left")
    alone = F.col("m").isNull()
    current = store(
        current.select(
            "node", "n", "vector", "ball", F.coalesce("m", F.lit(1)).alias("m"), F.when(alone, F.col("vector")).otherwise(F.col("centre")).alias("centre"),
            F.when(alone, 0.0).otherwise(F.acos(F.least(F.lit(1.0), "cosine"))).alias("reach"),
        ),
        "current",
    )
    blocks, tables = layout(current.count(), chance_meetings)
    pairs = store(candidates(current, blocks, tables), "pairs")
    firsts = current.select("node", "ball").join(nodes.select("node", "first"), "node")
    firsts = firsts.groupBy("ball").agg(F.min("first").alias("first"))
    heads = current.groupBy("ball").agg(
        F.first("m").alias("m"), F.sum("n").alias("n"), F.first("reach").alias("reach"), F.first("centre").alias("centre")
    )
    heads = store(heads.join(firsts, "ball"), "heads")
    judged = store(_judged(pairs, heads), "judged")
    asked = _asked(judged.where("verdict is null"), current)

    whole = judged.where("verdict = 1")
    links = store(whole.select("a", "b").union(asked.select("a", "b").distinct()), "ball_links")
    by_ball = whole.select(F.col("a").alias("ball"), F.col("n_b").alias("k")).union(whole.select(F.col("b").alias("ball"), F.col("n_a").alias("k")))
    by_ball = by_ball.groupBy("ball").agg(F.sum("k").alias("k"))
    by_node = asked.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(links).withColumnRenamed("node", "ball")
    named = store(
        heads.join(label, "ball", "left").join(by_ball, "ball", "left").select(
            "ball", "first", F.coalesce("label", "ball").alias("label"), (F.col("n") - 1 + F.coalesce("k", F.lit(0))).alias("k")
        ),
        "named",
    )
    least = store(named.groupBy("label").agg(F.min("first").alias("component_id")), "least")
    per_ball = store(named.join(least, "label").select("ball", "k", "component_id"), "per_ball")
    found = current.select("node", "ball").join(per_ball, "ball").join(by_node, "node", "left").join(nodes.select("node", "h0", "h1"), "node")
    found = store(found.select("h0", "h1", (F.col("k") + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "found")
    rows = ids.join(found, ["h0", "h1"], "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
