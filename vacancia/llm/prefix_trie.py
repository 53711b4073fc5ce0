"""Trie of the turns of conversations, from digests of prefixes and a count-min sketch.

Turns are numbered within their conversation, and a conversation takes over the first turns of
another one (see ``rebuilt``). A prefix is named by the sum of the mixed digests of its turns and
places: running sums over sorted ranges give it for every turn, without a task per conversation.

A count-min sketch counts the names of all prefixes. Its estimate is never too low, so an estimate
of one proves that the prefix is in one conversation, and so is every longer one: all that the
trie says of such a node follows from its own row. Only prefixes of other estimates move, and are
grouped exactly. What is shared by two or more conversations is closed under parents; sums over
subtrees are worked out on these nodes by doubling: in each round a node adds what the nodes at
twice the distance have summed so far.

Defined cases: a null role or text is empty; turns of one number stand in order of their digests,
a null number first; rows without a conv_id belong to no conversation and are left out; a
conversation without turns ends at the root; an empty table has no nodes. Other columns are left
out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved
from vacancia.llm.flat import mix
from vacancia.llm.running import running

SHARED = 20  # a conversation takes turns from the one whose id is the next lower multiple
TAKEN = 4  # and takes fewer turns than this
ROWS = 4  # counters that a name is counted in
CELLS = (1 << 14, 1 << 24)  # counters in each of them: at least, and at most (a byte each)
PIECE = 1 << 14  # counters that move as one row
TEXT = 1 << 16  # bytes of ids that move as one row
NAME = ["depth", "p1", "p2"]
_U = np.uint64


def _half(text: Column, at: int) -> Column:
    """60 bits of a digest in hex."""
    return F.conv(F.substring(text, at, 15), 16, 10).cast("bigint")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1 on), two digests and the words of every turn; texts go no further."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    digest = F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"),
        F.regexp_count(said[1], F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"), F.lit(1).cast("bigint").alias("one"),
    )
    placed = running(rows, "conv_id", ["turn", "digest"], ["one"], "turns")
    return placed.select("conv_id", F.col("run_one").alias("place"), _half(F.col("digest"), 1).alias("h1"), _half(F.col("digest"), 16).alias("h2"), "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth, h1, h2, words, length) and all conversations (conv_id, length)."""
    turns = saved(turns_of(conversations), "placed")
    taken = F.crc32(F.col("conv_id").cast("string")) % TAKEN
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("conv_id", "own", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % SHARED).alias("lender"))
    convs = saved(convs, "convs")
    lenders = convs.select(F.col("conv_id").alias("lender"), F.col("own").alias("has"))
    got = F.least("taken", F.coalesce("has", F.lit(0)))
    convs = saved(convs.join(lenders, "lender", "left").select("conv_id", "lender", "taken", got.alias("got"), (got + F.greatest(F.col("own") - F.col("taken"), F.lit(0))).alias("length")), "convs")
    own = turns.where(F.col("place") > taken).join(convs, "conv_id").select("conv_id", (F.col("place") - F.col("taken") + F.col("got")).alias("depth"), "h1", "h2", "words", "length")
    lent = turns.where((F.col("place") < TAKEN) & (F.col("conv_id") % SHARED == 0)).withColumnRenamed("conv_id", "lender")
    lent = lent.join(convs.where("got > 0"), "lender").where("place <= got").select("conv_id", F.col("place").alias("depth"), "h1", "h2", "words", "length")
    return own.unionByName(lent), convs.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each rebuilt turn with the names of the prefix it ends (p1, p2) and of the one before it (q1, q2)."""

    def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column("depth").to_numpy().astype(_U)
            names = [mix(batch.column(c).to_numpy().astype(np.int64).view(_U) * _U(16) + _U(k) ^ mix(depth * _U(0x9E3779B97F4A7C15) + _U(k))) for k, c in enumerate(("h1", "h2"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "depth", "words", "length")], *[pa.array(x.view(np.int64)) for x in names]], ["conv_id", "depth", "words", "length", "p1", "p2"])

    rows = turns.select("conv_id", "depth", "words", "length", "h1", "h2").mapInArrow(mixed, "conv_id bigint, depth bigint, words bigint, length bigint, p1 bigint, p2 bigint")
    summed = running(rows, "conv_id", ["depth"], ["p1", "p2"], "prefixes")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(f"run_{c}").to_numpy().view(_U) for c in ("p1", "p2")]
            step = [batch.column(c).to_numpy().view(_U) for c in ("p1", "p2")]
            names = [*own, *[a - b for a, b in zip(own, step)]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "depth", "words", "length")], *[pa.array(x.view(np.int64)) for x in names]], ["conv_id", "depth", "words", "length", "p1", "p2", "q1", "q2"])

    return saved(summed.mapInArrow(split, "conv_id bigint, depth bigint, words bigint, length bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint"), "prefixes")


def cells(p1: np.ndarray, p2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The counter of each name in every row of the sketch."""
    for k in range(ROWS):
        yield (mix(p1.view(_U) + _U(k + 1) * mix(p2.view(_U))) % _U(width)).astype(np.int64)


def sketch(rows: DataFrame) -> np.ndarray:
    """Counters (ROWS x width) of all names: none, one, or two for any more.

    As many counters as names, twice, up to the most of ``CELLS``; beyond it fewer estimates are
    one and more rows move, and the trie is the same.
    """
    n = rows.count()
    width = min(max(1 << int(2 * n).bit_length(), CELLS[0]), CELLS[1])
    piece = min(PIECE, width)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS, width), np.uint8)
        for batch in batches:
            for row, at in zip(table, cells(batch.column("p1").to_numpy(), batch.column("p2").to_numpy(), width)):
                known, times = np.unique(at, return_counts=True)
                row[known] = np.minimum(row[known] + np.minimum(times, 2), 2)
        pieces = table.reshape(-1, piece)
        for k in np.flatnonzero(pieces.any(1)):
            yield pa.RecordBatch.from_arrays([pa.array([int(k)]), pa.array([pieces[k].tobytes()])], ["piece", "counters"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("piece").to_pylist(), batch.column("counters").to_pylist()):
                totals[k] = np.minimum(totals.get(k, 0) + np.frombuffer(x, np.uint8), 2)
        for k, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total.astype(np.uint8).tobytes()])], ["piece", "counters"])

    parts = rows.select("p1", "p2").mapInArrow(counted, "piece bigint, counters binary").repartition("piece")
    out = np.zeros((ROWS * width // piece, piece), np.uint8)
    for r in parts.mapInArrow(merged, "piece bigint, counters binary").collect():  # ROWS x CELLS bytes at most
        out[r["piece"]] = np.frombuffer(r["counters"], np.uint8)
    return out.reshape(ROWS, width)


def screened(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """``alone``: the sketch proves that the prefix is in one conversation; ``before``: also the one before it."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            alone, before = (
                np.minimum.reduce([row[at] for row, at in zip(table, cells(batch.column(a).to_numpy(), batch.column(b).to_numpy(), table.shape[1]))]) == 1
                for a, b in (("p1", "p2"), ("q1", "q2"))
            )
            before &= batch.column("depth").to_numpy() > 1
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(alone | before), pa.array(before)], [*names, "alone", "before"])

    return rows.mapInArrow(run, ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields], "alone boolean", "before boolean"]))


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` (id, up, values): each value summed over the node and all nodes below it.

    ``up`` is the parent's id, null at the root. After k rounds a node has summed what lies less
    than 2**k below it, and ``up`` is 2**k above it.
    """
    sums = saved(nodes.select("id", "up", *values), "sums")
    while not sums.where("up IS NOT NULL").isEmpty():
        given = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        jump = sums.select(F.col("id").alias("up"), F.col("up").alias("next"))
        stepped = sums.where("up IS NOT NULL").join(jump, "up").select("id", F.col("next").alias("up"))
        sums = saved(
            sums.drop("up").join(given, "id", "left").join(stepped, "id", "left").select("id", "up", *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]),
            "sums",
        )
    return sums.drop("up")


def ends_digest(ends: DataFrame) -> DataFrame:
    """The digest of the comma-joined ids of every node (p1, p2, depth, conv_id), ascending.

    Ids are sorted by ranges and joined where they lie. A node that lies within one partition is
    digested there. One that reaches over several goes on as pieces of joined ids, not as rows.
    """
    ordered = ends.select(*NAME, "conv_id").repartitionByRange(*NAME, "conv_id").sortWithinPartitions(*NAME, "conv_id")
    named = ", ".join(f"{c} bigint" for c in NAME)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size, least, whole = None, [], 0, None, False
        for batch in batches:
            out = []
            for *at, conv in zip(*[batch.column(c).to_pylist() for c in (*NAME, "conv_id")]):
                if at != node or size > TEXT:
                    if node is not None:
                        out.append((*node, least, ",".join(ids), whole and at != node))
                        whole = at != node  # the partition's first node may have begun before it
                    node, ids, size, least = at, [], 0, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield _pieces(out)
        if node is not None:
            yield _pieces([(*node, least, ",".join(ids), False)])

    pieces = saved(ordered.mapInArrow(joined, f"{named}, least bigint, ids string, whole boolean"), "ends")
    digest = F.sha2("ids", 256).alias("ends_sha256")
    parts = pieces.where("NOT whole").repartition(*NAME).sortWithinPartitions(*NAME, "least")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*[batch.column(c).to_pylist() for c in (*NAME, "ids")]):
                if at != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _digests(out)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    return pieces.where("whole").select(*NAME, digest).unionByName(parts.select(*NAME, "ids").mapInArrow(chained, f"{named}, ends_sha256 string"))


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 4, pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], [*NAME, "least", "ids", "whole"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 3, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], [*NAME, "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations."""
    turns, convs = rebuilt(conversations)
    rows = prefixes(turns)
    rows = saved(screened(rows, sketch(rows)), "screened")
    total = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = total.select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), "conv_id", "n_convs", zero.alias("words"), zero.alias("length"))

    # what may be shared moves, and is grouped exactly
    exact = rows.where("NOT alone").groupBy(*NAME, "q1", "q2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("length").alias("length")
    )
    exact = saved(exact.unionByName(root), "exact")
    shared = exact.where("n_convs > 1 OR depth = 0")
    own = ["conv_id", "depth", "q1", "q2", "length"]
    single = exact.where("n_convs = 1 AND depth > 0").select(*own).unionByName(rows.where("alone AND NOT before").select(*own))
    inside = rows.where("before").select(*own)

    # children of what is shared are counted by its name before they meet it
    below = F.col("depth") - 1
    at = [below.alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    kids = shared.where("depth > 0").select(*at, zero.alias("tails")).unionByName(single.select(*at, F.lit(1).cast("bigint").alias("tails")))
    kids = kids.groupBy(*NAME).agg(F.count(F.lit(1)).alias("n_children"), F.sum("tails").alias("tails"))
    identity, parent = F.struct(*NAME), F.when(F.col("depth") > 0, F.struct(*at))
    shared = shared.join(kids, NAME, "left").select(
        identity.alias("id"), parent.alias("up"), "conv_id", "depth", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("tails")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    shared = saved(shared, "shared")
    sums = subtree_sums(shared, ["n_leaves", "saved_tokens"])

    ended = rows.where("NOT alone AND depth = length").select(*NAME, "conv_id").unionByName(convs.where("length = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id"))
    ended = ended.join(shared.select("id.*"), NAME, "left_semi")
    ends = ends_digest(ended).select(identity.alias("id"), "ends_sha256")
    none = F.sha2(F.lit(""), 256)
    holders = saved(shared.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id")), "holders")
    nodes = shared.drop("n_leaves", "saved_tokens").join(sums, "id").join(ends, "id", "left").join(holders, "up", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )

    # a node of one conversation says all of itself but its parent's conversation
    tops = single.withColumn("up", F.struct(*at)).join(holders, "up", "left").select(*own, F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"))
    alone = tops.unionByName(inside.withColumn("parent_conv_id", F.col("conv_id"))).select(
        "conv_id", "depth", "parent_conv_id", F.lit(1).cast("bigint").alias("n_convs"), (F.col("depth") < F.col("length")).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    return nodes.unionByName(alone)
