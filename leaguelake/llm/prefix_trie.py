"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns (role, text); a conversation that begins with it is a member. Nodes are known
by depth and two sums of 63 bits over position-tagged hashes of the turns, so every prefix of a conversation gets its
node by a running sum, which splits into blocks for conversations of any length.

Totals of subtrees: nodes with one member are the rest of that conversation, so they need no pass. Of the others (the
shared nodes), those with at most the square root of all rows beneath are light. The topmost light nodes are shard roots:
their subtrees are shards of bounded size. Each shard is sorted by reverse level order (Spark's external sort); a node
takes the messages for it from a priority queue, which spills sorted runs to Spark's local folders, and sends its totals
to its parent. Then the same is done across shard roots: their totals are summed by parent (before the shuffle) and the
heavy nodes above pass them on, in shards by the first turn. A level has at most as many heavy nodes as the square root
of all rows, so no queue outgrows that. The root sums up the first turns.

Defined cases: turns are ordered by turn (NULL first), ties by role, then by a hash of the text; NULL role or text is
empty; rows without conv_id are in no conversation; repeated rows are turns of their own; an empty table has no trie and gives
no rows; long texts count whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leaguelake.llm.common import mapped
from leaguelake.operators.ordered import number_rows
from leaguelake.session import held

BLOCK = 100_000
FIELD = "9223372036854775807BD"
# messages that a queue keeps in memory, and ids of one piece of text to be hashed
QUEUE_ITEMS, HASHED_IDS = 1 << 18, 1 << 12
ID = ["depth", "x", "y"]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


# --- turns and prefixes --------------------------------------------------------------------------------------------------

def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, a, b, chars): the turns of each conversation in order, known by two hashes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"), F.length(text).cast("bigint").alias("chars"),
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("a"), F.col("b")]
    return held(number_rows(turns, ["conv_id"], order, "place").select("conv_id", "place", "a", "b", "chars"), "turns")


def rebuilt(turns: DataFrame, group: int = 100, spread: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations as in a corpus with shared beginnings: (conv_id, length), and their turns (conv_id, length, depth, a, b, chars).

    Conversation c begins with the first h turns of conversation c - c % ``group``, h = crc32(decimal c) % ``spread``, and goes
    on with its own turns after its first h.
    """
    basis, h = F.col("conv_id") - F.col("conv_id") % group, F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("conv_id", "own", basis.alias("basis"), h.alias("h"))
    bases = own.filter("conv_id = basis").select("basis", F.least("own", F.lit(spread - 1)).alias("there"))
    lead = F.least("h", F.coalesce("there", F.lit(0)))
    convs = held(
        own.join(bases, "basis", "left").withColumn("lead", lead)
        .select("conv_id", "basis", "h", "lead", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
        "conversations",
    )
    columns = ["conv_id", "length", "depth", "a", "b", "chars"]
    later = turns.join(convs, "conv_id").filter("place > h").withColumn("depth", F.col("place") - F.col("h") + F.col("lead")).select(columns)
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < spread)).withColumnRenamed("conv_id", "basis")
    begun = first.join(convs, "basis").filter("place <= lead").withColumnRenamed("place", "depth").select(columns)
    return convs.select("conv_id", "length"), later.unionByName(begun)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, x, y, px, py, chars): the node of every prefix, and its parent."""
    tagged = turns.withColumns(
        {lane: F.xxhash64(F.lit(i), "depth", source).cast("decimal(20,0)") for i, (lane, source) in enumerate((("u", "a"), ("v", "b")))}
    ).withColumn("block", F.expr(f"(depth - 1) div {BLOCK}"))
    within = Window.partitionBy("conv_id", "block").orderBy("depth")
    sums = tagged.filter(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(F.sum("u").alias("bu"), F.sum("v").alias("bv"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "block", F.sum("bu").over(earlier).alias("bu"), F.sum("bv").over(earlier).alias("bv"))

    def total(lane: str, until: Column | None = None) -> Column:
        whole = F.sum(lane).over(within) + F.coalesce(F.col("b" + lane), F.lit(0))
        return F.pmod(whole if until is None else whole - until, F.expr(FIELD)).cast("bigint")

    return tagged.join(before, ["conv_id", "block"], "left").select(
        "conv_id", "length", "depth", total("u").alias("x"), total("v").alias("y"),
        total("u", F.col("u")).alias("px"), total("v", F.col("v")).alias("py"), "chars",
    )


# --- time-forward processing ---------------------------------------------------------------------------------------------

class SpillingQueue:
    """A priority queue of tuples; what exceeds ``limit`` goes to sorted runs in Spark's local folders."""

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.runs = limit, [], []

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=folder)
        self.heap.sort()
        for item in self.heap:
            pickle.dump(item, run)
        run.seek(0)
        self.heap = []
        self._advance(run)

    def _advance(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def first(self) -> tuple | None:
        heads = self.heap[:1] + [run[0] for run in self.runs[:1]]
        return min(heads) if heads else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] <= self.heap[0]):
            item, _, run = heapq.heappop(self.runs)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


TOTALS = ["children", "leaves", "saved", "members"]
FORWARD = ["gd", "gx", "gy", *ID, "px", "py", "conv_id", "n_convs", "going", "chars", *TOTALS]
DONE = "depth bigint, x bigint, y bigint, px bigint, py bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, shard_root boolean"


def _pass_up(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of the nodes of each shard, which come in reverse level order; only a shard's root has its parent elsewhere."""
    queue, shard = SpillingQueue(), None
    for batch in rows:
        out = []
        for node in zip(*(column.to_pylist() for column in batch.columns)):
            root, (depth, x, y, px, py, conv, n, going, chars), (children, leaves, saved, members) = node[:3], node[3:12], node[12:]
            if root != shard:
                if len(queue):
                    raise ValueError("messages to nodes outside the shard")
                shard = root
            while (message := queue.first()) is not None and message[:3] == (-depth, x, y):
                _, _, _, l, s, m = queue.pop()
                children, leaves, saved, members = children + 1, leaves + l, saved + s, members + m
            alone = going - members  # members that go on without company
            children, leaves = children + alone, leaves + alone
            leaves, saved = leaves if children else 1, saved + (n - 1) * chars
            top = (depth, x, y) == root
            if not top:
                queue.push((1 - depth, px, py, leaves, saved, n))
            out.append((depth, x, y, px, py, conv, n, children, leaves, saved, top))
        if out:
            columns = list(zip(*out))
            names = [field.split()[0] for field in DONE.split(", ")]
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.bool_())], names)


def pass_up(nodes: DataFrame) -> DataFrame:
    """Nodes with totals of their subtrees, from nodes with the ids of their shards' roots (gd, gx, gy) and totals from below."""
    sharded = nodes.select(FORWARD).repartition("gd", "gx", "gy").sortWithinPartitions("gd", "gx", "gy", F.desc("depth"), "x", "y")
    return mapped(sharded, _pass_up, DONE)


def messages(done: DataFrame) -> DataFrame:
    """What shard roots tell the nodes above, summed by receiver."""
    return done.filter("shard_root").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.sum("n_convs").alias("members")
    )


# --- digests of the conversations that end at a node ---------------------------------------------------------------------

def _joined_ids(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x, y, conv_id) as pieces of text of up to HASHED_IDS ids of one node."""
    node, ids = None, []

    def piece() -> pa.RecordBatch:
        columns = [[node[0]], [node[1]], [node[2]], [ids[0]]]
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in columns), pa.array([",".join(map(str, ids))])], [*ID, "least", "ids"])

    for batch in rows:
        for *this, conv in zip(*(column.to_pylist() for column in batch.columns)):
            if this != node or len(ids) == HASHED_IDS:
                if ids:
                    yield piece()
                node, ids = this, []
            ids.append(conv)
    if ids:
        yield piece()


def _digests(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's pieces, which come in order; a piece at a time is in memory."""
    node, digest = None, hashlib.sha256()

    def result() -> pa.RecordBatch:
        return pa.record_batch([*(pa.array([v], pa.int64()) for v in node), pa.array([digest.hexdigest()])], [*ID, "ends_sha256"])

    for batch in rows:
        for *this, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if this != node:
                if node is not None:
                    yield result()
                node, digest = this, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node is not None:
        yield result()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of nodes at which conversations end, from (depth, x, y, conv_id).

    A range-partitioned sort spreads a node with many ends over tasks, which join the ids; only those texts, one for
    HASHED_IDS ids, meet in the task that hashes them in turn, since SHA-256 cannot be split.
    """
    pieces = mapped(ends.select(*ID, "conv_id").repartitionByRange(*ID, "conv_id").sortWithinPartitions(*ID, "conv_id"), _joined_ids,
                    "depth bigint, x bigint, y bigint, least bigint, ids string")
    return mapped(pieces.repartition(*ID).sortWithinPartitions(*ID, "least"), _digests, "depth bigint, x bigint, y bigint, ends_sha256 string")


# --- the trie ------------------------------------------------------------------------------------------------------------

def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node of the trie of conversations (conv_id, length) with turns (conv_id, length, depth, a, b, chars)."""
    rows = held(prefixes(turns), "prefixes")
    least = math.ceil(math.sqrt(rows.count()))
    nodes = held(
        rows.groupBy(*ID).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("length") > F.col("depth")).alias("going"),
            F.min("chars").alias("chars"), F.min("px").alias("px"), F.min("py").alias("py"), F.sum(F.col("length") - F.col("depth") + 1).alias("rows"),
        ),
        "nodes",
    )
    shared = nodes.filter("n_convs > 1")
    heavy = shared.filter(F.col("rows") > least)
    nothing = {name: F.lit(0).cast("bigint") for name in TOTALS}
    # where each conversation's light part begins; heavy nodes are the beginning of a path
    begins = rows.join(heavy.select(ID), ID).groupBy("conv_id").agg((F.max("depth") + 1).alias("begin"))
    tops = rows.join(begins, "conv_id", "left").filter(F.col("depth") == F.coalesce("begin", F.lit(1)))

    def shard(of: DataFrame) -> DataFrame:
        return of.select("conv_id", F.col("depth").alias("gd"), F.col("x").alias("gx"), F.col("y").alias("gy"))

    light = held(pass_up(shared.filter(F.col("rows") <= least).join(shard(tops), "conv_id").withColumns(nothing)), "light")
    given = heavy.join(messages(light), ID, "left").withColumns({name: F.coalesce(name, F.lit(0)) for name in TOTALS})
    above = held(pass_up(given.join(shard(rows.filter("depth = 1")), "conv_id")), "above")
    told = messages(light.unionByName(above)).filter("depth = 0").drop(*ID)
    zero = F.lit(0).cast("bigint")
    counted = convs.select("conv_id", F.lit(1).cast("bigint").alias("n_convs"), (F.col("length") > 0).cast("bigint").alias("going"), *[zero.alias(t) for t in TOTALS])
    alone = F.sum("going") - F.sum("members")
    root = counted.unionByName(told.withColumns({"conv_id": F.lit(None).cast("bigint"), "n_convs": zero, "going": zero})).agg(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("px"), zero.alias("py"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), (F.sum("children") + alone).alias("n_children"),
        F.greatest(F.sum("leaves") + alone, F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    ).filter("n_convs > 0")
    single = nodes.filter("n_convs = 1").select(
        *ID, "px", "py", "conv_id", "n_convs", F.col("going").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens")
    )
    whole = single.unionByName(light.drop("shard_root")).unionByName(above.drop("shard_root")).unionByName(root)
    parents = nodes.select("depth", "x", "y", "conv_id").unionByName(root.select("depth", "x", "y", "conv_id")).select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id")
    )
    at_root = convs.filter("length = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id")
    digests = ends_digests(rows.filter("length = depth").select(*ID, "conv_id").unionByName(at_root))
    return (
        whole.join(parents, ["depth", "px", "py"], "left").join(digests, ID, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))
    )


def whole_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (conv_id, length) and turns, as ``trie`` takes them."""
    turns = placed_turns(conversations)
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("length"))
    return convs, turns.join(convs, "conv_id").withColumnRenamed("place", "depth")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(*whole_conversations(conversations))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with shared beginnings (see ``rebuilt``)."""
    return trie(*rebuilt(placed_turns(conversations)))
