"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``GRID`` places. Every shard stands at ``NODES`` of them, given by hashes of its number; a row is at the place
that the hash of its ``doc_id`` gives and belongs to the next node clockwise. A shard takes rows up to its load bound only.
Rows beyond it go on clockwise, node by node, to the first shard that still has room, so no shard that a row passes by has
room in the end, and with a bound that sums up to all rows, counts are at most one apart.

Which rows of an arc (the places up to one node) go on is settled by counts: rows of an arc are ordered by a hash of their
contents, a plan says how many of them, from which rank on, each shard takes. The counts that the plan is made of, one per
node, are all that the driver sees; their number is a parameter. Ranks are running sums of counts: cells of an arc by that
hash, each of about ``CELL`` rows, then the rows in a cell. Rows equal in id, size and checksum are one row with a count,
dealt in lots of ``LOT``, so that neither a frequent id nor copies of one row end in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import pick, stored

#: Places on the ring, as hexadecimal digits of a hash, and nodes per shard.
GRID_DIGITS, NODES = 4, 128
GRID = 16 ** GRID_DIGITS
#: Rows that are ranked in one go, about; and equal rows that are dealt together.
CELL, LOT = 4096, 4096
#: Hexadecimal digits of the order within an arc.
TURN_DIGITS = 15
KEY = ["doc_id", "size", "text_crc32"]


def _number(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """``node, owner, place`` of all nodes, numbered in ring order; of nodes at one place only the first gets rows."""
    every = spark.range(0, shards * nodes, 1, 1).select(
        F.expr(f"id div {nodes}").cast("int").alias("owner"), (F.col("id") % nodes).alias("copy"))
    placed = every.select("owner", "copy", _number(F.md5(F.concat_ws("/", F.col("owner").cast("string"), F.col("copy").cast(
        "string"))), GRID_DIGITS).alias("place"))
    order = W.orderBy("place", "owner", "copy")  # as many rows as nodes
    return placed.select((F.row_number().over(order) - 1).alias("node"), "owner", "place")


def arcs(nodes: DataFrame) -> DataFrame:
    """``place, node, home`` for all places of the ring: at most ``GRID`` rows, however large the data."""
    order = W.orderBy("node")
    ends = nodes.select("*", F.lag("place", 1, -1).over(order).alias("before"))
    upto = ends.where("place > before").select(
        F.explode(F.sequence(F.col("before") + 1, F.col("place"))).alias("place"), "node", F.col("owner").alias("home"))
    last = nodes.agg(F.max("place").alias("last"), F.min_by("owner", "node").alias("home"))
    beyond = last.where(F.col("last") < GRID - 1).select(
        F.explode(F.sequence(F.col("last") + 1, F.lit(GRID - 1).cast("long"))).alias("place"), F.lit(0).alias("node"), "home")
    return upto.union(beyond)


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows for each shard. Without slack they sum up to all rows and are at most one apart."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def plan(counts: list[int], owners: list[int], limits: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(node, first, n, shard, slot)``: of the rows of a node's arc, ``n`` from rank ``first`` on go to the shard, from that slot on.

    All arcs go on together, one node clockwise per round; arcs that come to one shard in a round are served in ring order.
    """
    left, used, runs = list(counts), [0] * len(limits), []
    for step in range(len(owners)):
        if not any(left):
            break
        for node, rest in enumerate(left):
            shard = owners[(node + step) % len(owners)]
            taken = min(rest, limits[shard] - used[shard])
            if taken:
                runs.append((node, counts[node] - rest, taken, shard, used[shard]))
                left[node] -= taken
                used[shard] += taken
    return runs


def _turn(*parts: Column) -> Column:
    return _number(F.md5(F.concat_ws("/", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])), TURN_DIGITS)


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"), *more)


def _dealt(keyed: DataFrame, shards: int, nodes: int, slack: float) -> DataFrame:
    """``KEY, lot, home, shard, skip, part, slot``: of a lot's rows, ``part`` after the first ``skip`` go to the shard, from that slot on."""
    circle = stored(ring(keyed.sparkSession, shards, nodes), "ring")
    lot = F.expr(f"CASE WHEN lot < (copies - 1) div {LOT} THEN {LOT} ELSE copies - lot * {LOT} END")
    lots = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).select(
        *KEY, "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {LOT}"))).alias("lot")).select(
        *KEY, "lot", lot.alias("n"), _number(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), GRID_DIGITS).alias("place"),
        _turn(F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("lot")).alias("turn"))
    there = stored(lots.join(F.broadcast(arcs(circle)), "place").drop("place"), "ring-rows")

    counts = {row["node"]: row["n"] for row in there.groupBy("node").agg(F.sum("n").alias("n")).collect()}
    owners = [row["owner"] for row in circle.orderBy("node").collect()]
    rows = sum(counts.values())
    runs = _frame(keyed.sparkSession, plan([counts.get(node, 0) for node in range(len(owners))], owners, bounds(rows, shards, slack)))

    cells = max(1, rows // CELL)
    celled = there.withColumn("cell", F.expr(f"cast(floor(turn * {cells}D / {16.0 ** TURN_DIGITS}D) AS INT)"))
    starts = celled.groupBy("node", "cell").agg(F.sum("n").alias("all")).select(
        "node", "cell", (F.sum("all").over(W.partitionBy("node").orderBy("cell")) - F.col("all")).alias("start"))
    inside = W.partitionBy("node", "cell").orderBy("turn", *KEY, "lot")
    ranked = celled.withColumn("within", F.sum("n").over(inside) - F.col("n")).join(starts, ["node", "cell"]).withColumn(
        "first", F.col("start") + F.col("within"))
    low, high = F.greatest("first", "from"), F.least(F.col("first") + F.col("n"), F.col("from") + F.col("taken"))
    return ranked.join(F.broadcast(runs), "node").where(low < high).select(
        *KEY, "lot", "home", "shard", (low - F.col("first")).alias("skip"), (high - low).alias("part"),
        (F.col("base") + low - F.col("from")).alias("slot"))


def _frame(spark: SparkSession, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan as a frame: about one run per node, and one more for each that rounds have parted."""
    columns = ["node", "from", "taken", "shard", "base"]
    numbers = F.array(*[F.split(F.lit(",".join(str(run[i]) for run in runs or [(-1, 0, 0, 0, 0)])), ",") for i in range(5)])
    one = spark.range(0, 1, 1, 1).select(F.explode(F.arrays_zip(*[numbers[i].alias(c) for i, c in enumerate(columns)])).alias("run"))
    return one.select(*[F.col("run")[c].cast("int" if c in ("node", "shard") else "long").alias(c) for c in columns])


def places(docs: DataFrame, shards: int = 8, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, home, shard, slot`` for every row of ``docs`` (``doc_id``, ``text``).

    ``size`` is the text's bytes in UTF-8 plus 1, null text counts as empty; ``home`` is the shard of the row's place on the
    ring, ``shard`` the one that it goes to, ``slot`` its place there, gapless from 0. All null ids are at one place. Rows
    that share an id share the place, and are dealt like others when it overflows; rows repeated in full come out as often,
    each with a slot of its own. Very long texts are rows like others, other columns are not read, an empty table gives an
    empty one. Without ``slack`` the counts of shards are at most one apart; with it a shard takes up to (1 + slack) of the
    mean, and fewer rows leave home.
    """
    dealt = _dealt(_keyed(pick(docs, {"doc_id": "long", "text": "string"})), shards, nodes, slack)
    return dealt.select(*KEY, "home", "shard", F.explode(F.sequence("slot", F.col("slot") + F.col("part") - 1)).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, nodes: int = NODES, slack: float = 0.0) -> None:
    """Write every row of ``docs``, with all columns and its slot, as Parquet below ``path``, one folder per shard.

    Nulls, ties, repeats and an empty table are as in :func:`places`; columns named like the added ones stay beside them, in
    the struct ``row``. Rows equal in id, size and checksum are numbered within the partition that they were read in, then
    across partitions, so they never meet in one task.
    """
    kept = stored(_keyed(pick(docs, {"doc_id": "long", "text": "string"}, row=True), "row").withColumn(
        "at", F.monotonically_increasing_id()), "shard-rows")
    key = F.struct(*KEY).alias("key")  # nulls in it are alike
    slim = kept.select(key, "at", F.shiftright("at", 33).alias("read"))
    order = W.partitionBy("key").orderBy("read")
    offsets = slim.groupBy("key", "read").agg(F.count(F.lit(1)).alias("n")).select(
        "key", "read", (F.sum("n").over(order) - F.col("n")).alias("before"))
    numbered = slim.withColumn("own", F.row_number().over(W.partitionBy("key", "read").orderBy("at")) - 1).join(
        offsets, ["key", "read"]).select("key", "at", (F.col("before") + F.col("own")).alias("copy"))
    dealt = _dealt(kept.select(*KEY), shards, nodes, slack).select(key, "lot", "shard", "skip", "part", "slot")
    inside = F.col("copy") % LOT - F.col("skip")
    placed = numbered.withColumn("lot", F.expr(f"copy div {LOT}")).join(dealt, ["key", "lot"]).where(
        (inside >= 0) & (inside < F.col("part"))).select("at", "shard", (F.col("slot") + inside).alias("slot"))
    clash = len({name.lower() for name in [*docs.columns, "shard", "slot"]}) < len(docs.columns) + 2
    columns = ["row"] if clash else [F.col("row")[f"c{i}"].alias(name) for i, name in enumerate(docs.columns)]
    kept.join(placed, "at").select(*columns, "shard", "slot").hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
