"""The prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

Conversations are sorted by their sequences of turn digests. Neighbours are linked by an edge that weighs the number of
turns they share; each sorted partition takes its edges in descending depth, and every merge of components makes a
branching node. What a partition cannot know alone, the nodes that its first or last row shares with the partition
beside it, it contracts to partial counts, and those of one prefix are added up across partitions.

A conversation of more than ``STRIP`` turns is cut into strips, so that no row grows with a conversation: a strip is
sorted below the digest of all turns before it, and its tree hangs from the node that ends the strip above, which is
one more node merged across borders. Turns are placed by running counts over range-partitioned slices.

Totals of a subtree are sums over edges: members past the first each bring the bytes of the prefix they share with
the row before, so a node needs no walk over its descendants.

Defined cases: a null role or text is empty; rows without conv_id are no conversation and are left out; a null turn
comes first; rows that share a turn number come in the order of their digests, equal rows as often as they stand; a
conversation without turns ends at the root; an empty table has no nodes; other columns are not read. Turns are told
apart by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.operators.parts import weight_before
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import shared_folder, written

#: Turns in a row of the sort at most.
STRIP = 1024
#: Turns that a conversation borrows at most, and how many neighbours borrow from the same one.
BORROWED, FAMILY = 8, 5
DIGEST = 16

ROW = ["strip", "k1", "k2", "digests", "more", "conv_id"]
NODE = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved long, ends_sha256 string, key string, parent_key string, bytes_before long, ids string, pid int")
CLOSED, CHILD_OF_OPEN, OPEN = range(3)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Per distinct turn row of a conversation: digest, bytes of the text, copies, and ``before``, the turns before it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.substring(F.sha2(marked, 256), 1, 2 * DIGEST).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")).where("conv_id is not null")
    counted = turns.groupBy("conv_id", "turn", "digest", "bytes").agg(F.count(F.lit(1)).alias("copies"))
    return weight_before(counted, "conv_id", ["turn", "digest"], F.col("copies"), few=False).select(
        "conv_id", "digest", "bytes", "copies", "before")


def _own_pieces(placed: DataFrame, skipped: Column, shift: Column, strip: int) -> DataFrame:
    """The rows from ``skipped`` turns on, moved by ``shift``, cut where strips end."""
    moved = placed.select(
        "conv_id", "digest", "bytes", (F.greatest("before", skipped) + shift).alias("low"),
        (F.col("before") + F.col("copies") + shift).alias("high")).where("high > low")
    cut = moved.withColumn("strip", F.explode(F.expr(f"sequence(low div {strip}, (high - 1) div {strip})")))
    start = F.greatest("low", F.col("strip") * strip)
    return cut.select("conv_id", "strip", start.alias("start"),
                      (F.least("high", (F.col("strip") + 1) * strip) - start).cast("int").alias("n"), "digest", "bytes")


def _strips(pieces: DataFrame) -> DataFrame:
    """One row per conversation and strip: its digests and sizes, and what the strips before it add up to."""
    gathered = pieces.groupBy("conv_id", "strip").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "digest", "bytes"))).alias("turns"))
    rows = gathered.select(
        "conv_id", "strip", F.unhex(F.expr("array_join(transform(turns, t -> repeat(t.digest, t.n)), '')")).alias("digests"),
        F.expr("flatten(transform(turns, t -> array_repeat(t.bytes, t.n)))").alias("sizes"))
    mark = F.md5(F.concat(F.encode(F.concat(F.col("strip").cast("string"), F.lit(" ")), "UTF-8"), F.col("digests")))
    part = lambda at: F.conv(F.substring(mark, at, 15), 16, 10).cast("decimal(38,0)")
    rows = rows.withColumns({"h1": part(1), "h2": part(16), "total": F.expr("aggregate(sizes, 0L, (a, b) -> a + b)")})
    order = Window.partitionBy("conv_id").orderBy("strip")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    return rows.select(
        "strip", F.coalesce(F.sum("h1").over(before), zero).cast("decimal(38,0)").alias("k1"),
        F.coalesce(F.sum("h2").over(before), zero).cast("decimal(38,0)").alias("k2"), "digests",
        F.lead("strip").over(order).isNotNull().alias("more"), "conv_id", "sizes",
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("bytes_before"))


def _started(ids: DataFrame) -> DataFrame:
    """A piece without turns for every conversation, so that those without any have a row."""
    return ids.select("conv_id", F.lit(0).cast("long").alias("strip"), F.lit(-1).cast("long").alias("start"),
                      F.lit(0).alias("n"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("bytes"))


def as_they_are(conversations: DataFrame, strip: int = STRIP) -> DataFrame:
    """The strips of the conversations with the turns they have."""
    placed = written(placed_turns(conversations), "turns")
    none = F.lit(0).cast("long")
    return _strips(_own_pieces(placed, none, none, strip).unionByName(_started(placed.select("conv_id").distinct())))


def rebuilt(conversations: DataFrame, strip: int = STRIP) -> DataFrame:
    """The strips of the conversations after each has put its first turns for those of the first of its family.

    Conversation c takes the first h = crc32(c) % 9 turns of conversation c - c % 5, and its own from turn h on.
    """
    placed = written(placed_turns(conversations), "turns")
    ids = placed.select("conv_id").distinct().select(
        "conv_id", (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % (BORROWED + 1)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first_id"))
    first = placed.where(F.col("before") < BORROWED).groupBy(F.col("conv_id").alias("held_id")).agg(
        F.sort_array(F.collect_list(F.struct("before", "digest", "bytes", "copies"))).alias("turns")).select(
        "held_id", F.expr(f"slice(flatten(transform(turns, t -> array_repeat(struct(t.digest, t.bytes), "
                          f"cast(least(t.copies, {BORROWED}) as int)))), 1, {BORROWED})").alias("first_turns"))
    heads = written(ids.join(first, F.col("first_id") == F.col("held_id"), "left").select(
        "conv_id", "h", F.expr("coalesce(slice(first_turns, 1, cast(h as int)), array())").alias("head")), "heads")
    sizes = heads.select(F.col("conv_id").alias("head_id"), "h", F.size("head").cast("long").alias("taken"))
    own = _own_pieces(placed.join(sizes, F.col("conv_id") == F.col("head_id")), F.col("h"), F.expr("taken - h"), strip)
    borrowed = heads.select("conv_id", F.posexplode("head").alias("start", "turn")).select(
        "conv_id", F.lit(0).cast("long").alias("strip"), F.col("start").cast("long").alias("start"),
        F.lit(1).alias("n"), "turn.digest", "turn.bytes")
    return _strips(own.unionByName(borrowed).unionByName(_started(heads)))


def common_turns(a: bytes, b: bytes) -> int:
    """Digests that both begin with."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    if a[:high * DIGEST] == b[:high * DIGEST]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * DIGEST] == b[:middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def shared_depth(row: tuple, other: tuple, strip: int) -> int:
    """Depth that two rows (strip, k1, k2, digests) share; -1 if they are of different trees."""
    return row[0] * strip + common_turns(row[3], other[3]) if row[:3] == other[:3] else -1


class Slice:
    """The rows of one sorted partition as columns, with the depth that each shares with the row before."""

    def __init__(self, batches: Iterator[pa.RecordBatch], strip: int, first: int, following: int):
        names = ["strip", "k1", "k2", "digests"]
        self.rows: list[tuple] = []
        held: dict[str, list[np.ndarray]] = {n: [] for n in ("more", "conv_id", "bytes_before", "x_saved", "x_leaves")}
        sizes, lengths = [], []
        for batch in batches:
            self.rows += [(s, int(a), int(b), d) for s, a, b, d in zip(
                *(batch.column(n).to_pylist() for n in names), strict=True)]
            for n, parts in held.items():
                parts.append(batch.column(n).to_numpy(zero_copy_only=False))
            lists = batch.column("sizes")
            sizes.append(lists.flatten().to_numpy(zero_copy_only=False))
            lengths.append(np.diff(lists.offsets.to_numpy()))
        m = len(self.rows)
        self.conv, self.before, self.x_saved, self.x_leaves = (
            np.concatenate(held[n]).astype(np.int64) if m else np.zeros(0, np.int64)
            for n in ("conv_id", "bytes_before", "x_saved", "x_leaves"))
        self.more = np.concatenate(held["more"]).astype(bool) if m else np.zeros(0, bool)
        turns = np.concatenate(lengths).astype(np.int64) if m else np.zeros(0, np.int64)
        self.at = np.concatenate([[0], np.cumsum(turns)])
        self.running = np.concatenate([[0], np.cumsum(np.concatenate(sizes) if m else [])]).astype(np.int64)
        self.floor = np.fromiter((r[0] * strip for r in self.rows), np.int64, m)
        self.end = self.floor + turns
        shared = [shared_depth(self.rows[i], self.rows[i - 1], strip) for i in range(1, m)]
        self.lcp = np.array(([first] if m else []) + shared, np.int64)
        after = np.append(self.lcp[1:], following)[:m]
        self.leaf = ((after < self.end) & ~self.more).astype(np.int64) + self.x_leaves
        self.weight = np.array([self.bytes_to(i, d) if d >= 0 else 0 for i, d in enumerate(self.lcp.tolist())], np.int64)

    def bytes_to(self, i: int, depth: int) -> int:
        """Bytes of row i's first ``depth`` turns."""
        return int(self.before[i] + self.running[self.at[i] + depth - self.floor[i]] - self.running[self.at[i]])

    def key(self, i: int, depth: int) -> str:
        """Digest of row i's first ``depth`` turns, the same wherever a strip begins."""
        strip, k1, k2, digests = self.rows[i]
        if depth > self.floor[i]:
            prefix = digests[:(depth - int(self.floor[i])) * DIGEST]
            mark = hashlib.md5(f"{strip} ".encode() + prefix).hexdigest()
            k1, k2 = k1 + int(mark[:15], 16), k2 + int(mark[15:30], 16)
        return f"{k1}:{k2}"


class Component:
    """Rows low..high of a slice that share the first ``depth`` turns."""

    __slots__ = ("low", "high", "n", "least", "weight", "leaves", "depth", "ended", "edges")

    def __init__(self, rows: Slice, i: int):
        self.low = self.high = i
        self.n, self.least, self.weight = 1, int(rows.conv[i]), int(rows.x_saved[i])
        self.leaves, self.depth, self.ended, self.edges = int(rows.leaf[i]), int(rows.end[i]), 1, 0

    def joined(self, other: Component, weight: int, depth: int) -> None:
        """Take up the component to the right; both meet at ``depth``."""
        if self.depth > depth:
            self.ended = self.edges = 0
        if other.depth == depth:
            self.ended += other.ended
            self.edges += other.edges
        self.edges += 1
        self.high, self.depth = other.high, depth
        self.n, self.least = self.n + other.n, min(self.least, other.least)
        self.weight, self.leaves = self.weight + other.weight + weight, self.leaves + other.leaves


def forest(rows: Slice, strip: int, first: int, following: int, pid: int) -> list[tuple]:
    """The nodes of one slice: whole ones, and the parts of those that reach over its borders."""
    made: list[tuple] = []
    last = len(rows.rows) - 1

    def open_to(c: Component) -> int:
        """Depth down to which the component's prefixes go on beyond the slice."""
        return max(first if c.low == 0 else -1, following if c.high == last else -1)

    def emit(c: Component, above: int, parent: int | None, parent_open: bool) -> None:
        """The chain of nodes from below ``above`` to the component's own depth; all have the same members."""
        reach, floor = open_to(c), int(rows.floor[c.low])
        for depth in range(above + 1, c.depth + 1):
            bottom = depth == c.depth
            ended = c.ended if bottom else 0
            own = rows.conv[c.low:c.low + ended][~rows.more[c.low:c.low + ended]]
            ids = ",".join(map(str, own)) if len(own) else None
            before = rows.bytes_to(c.low, depth - 1) if depth > floor else 0
            begun = c.low == 0 and depth <= first  # its first rows are another slice's
            upper_open = depth > 0 and (parent_open if depth == above + 1 else depth - 1 <= reach)
            upper_key = rows.key(c.low, depth - 1) if upper_open else None
            upper = None if upper_open else parent if depth == above + 1 else c.least
            if depth <= reach or depth == floor + strip:
                edges = (c.edges - ended if bottom else 0) + (first == depth if begun else 1)
                made.append((OPEN, c.least, depth, upper, c.n, edges, c.leaves,
                             c.weight + (int(rows.weight[0]) if begun else 0), None, rows.key(c.low, depth),
                             upper_key, before, ids, pid))
                continue
            made.append((CHILD_OF_OPEN if upper_open else CLOSED, c.least, depth, upper, c.n,
                         c.edges + 1 - ended if bottom else 1, c.leaves, c.weight - (c.n - 1) * before,
                         hashlib.sha256(ids.encode()).hexdigest() if ids else NO_ENDS, None, upper_key, None, None, pid))

    owner = list(range(last + 1))
    components = [Component(rows, i) for i in range(last + 1)]

    def find(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    edges = np.flatnonzero(rows.lcp[1:] >= 0) + 1
    edges = edges[np.argsort(-rows.lcp[edges], kind="stable")]
    cuts = np.flatnonzero(np.diff(rows.lcp[edges])) + 1
    for level in np.split(edges, cuts):
        if not len(level):
            continue
        depth = int(rows.lcp[level[0]])
        below = []
        for i in level.tolist():
            a, b = find(i - 1), find(i)
            below += [copy(side) for side in (components[a], components[b]) if side.depth > depth]
            components[a].joined(components[b], int(rows.weight[i]), depth)
            owner[b] = a
        for child in below:
            c = components[find(child.low)]
            emit(child, depth, c.least, depth <= open_to(c) or depth == rows.floor[c.low] > 0)
    for i in range(last + 1):
        if owner[i] != i:
            continue
        c, floor = components[i], int(rows.floor[i])
        emit(c, floor if floor else -1, None, floor > 0)
        if floor:  # what the strip adds to the node that it hangs from
            begun = i == 0 and floor <= first
            edges = (c.edges if c.depth == floor else 0) + (first == floor if begun else 1)
            made.append((OPEN, c.least, floor, None, 0, edges, 0, 0, None, rows.key(i, floor), None, None, None, pid))
    return made


def _borders(ordered: DataFrame, strip: int) -> dict[int, tuple[int, int]]:
    """Per partition that has rows: the depth its first row shares with the row before, its last with the row after.

    One pair of numbers per partition reaches the driver.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = tail = None
        for batch in batches:
            if batch.num_rows:
                head = batch.slice(0, 1) if head is None else head
                tail = batch.slice(batch.num_rows - 1, 1)
        if head is not None:
            pid = pa.array([TaskContext.get().partitionId()], pa.int32())
            columns = [pid, *(side.column(n) for side in (head, tail) for n in ROW[:4])]
            names = ["pid", *(f"{side}_{n}" for side in ("head", "tail") for n in ROW[:4])]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = dict(ordered.dtypes)
    fields = [f"{side}_{n} {kinds[n]}" for side in ("head", "tail") for n in ROW[:4]]
    found = written(ordered.select(*ROW[:4]).mapInArrow(ends, ", ".join(["pid int", *fields])), "borders")
    next_id = found.select(F.col("pid").alias("left_id"), F.lead("pid").over(Window.orderBy("pid")).alias("right_id"))
    pairs = next_id.where("right_id is not null").join(
        found.selectExpr("pid AS left_id", *(f"tail_{n} AS l_{n}" for n in ROW[:4])), "left_id").join(
        found.selectExpr("pid AS right_id", *(f"head_{n} AS r_{n}" for n in ROW[:4])), "right_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (list(zip(*(batch.column(f"{side}_{n}").to_pylist() for n in ROW[:4]), strict=True))
                           for side in ("l", "r"))
            shared = [shared_depth(a, b, strip) for a, b in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("left_id"), batch.column("right_id"), pa.array(shared, pa.int64())],
                                             ["left_id", "right_id", "shared"])

    shared = pairs.mapInArrow(compare, "left_id int, right_id int, shared long").collect()
    before, after = {r.right_id: r.shared for r in shared}, {r.left_id: r.shared for r in shared}
    return {pid: (before.get(pid, -1), after.get(pid, -1)) for pid in {*before, *after}}


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows in one order over all partitions; a checkpoint keeps the partitions as they are."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return rows.repartitionByRange(*ROW).sortWithinPartitions(*ROW).checkpoint()


def _lower_totals(ordered: DataFrame, borders: dict, strip: int) -> DataFrame:
    """Per tree of a lower strip: its least conversation, and the leaves and saved bytes of its own nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        rows = Slice(batches, strip, *borders.get(pid, (-1, -1)))
        lower = np.flatnonzero(rows.floor > 0)
        yield pa.RecordBatch.from_pylist([
            {"strip": rows.rows[i][0], "key": rows.key(i, int(rows.floor[i])), "conv_id": int(rows.conv[i]),
             "weight": int(rows.weight[i]), "leaves": int(rows.leaf[i]), "floor_bytes": int(rows.before[i])}
            for i in lower.tolist()], pa.schema([("strip", pa.int64()), ("key", pa.string()), ("conv_id", pa.int64()),
                                                 ("weight", pa.int64()), ("leaves", pa.int64()), ("floor_bytes", pa.int64())]))

    rows = ordered.mapInArrow(run, "strip long, key string, conv_id long, weight long, leaves long, floor_bytes long")
    return rows.groupBy("strip", "key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("t_leaves"),
        (F.sum("weight") - (F.count(F.lit(1)) - 1) * F.max("floor_bytes")).alias("t_saved")).drop("key")


def _with_lower_totals(rows: DataFrame, strip: int) -> DataFrame:
    """Each row with what hangs below its strip, counted once: with the least conversation of each lower tree."""
    plain = rows.withColumns({"x_saved": F.lit(0).cast("long"), "x_leaves": F.lit(0).cast("long")})
    if rows.where("strip > 0").isEmpty():
        return plain
    ordered = _sorted(plain)
    totals = _lower_totals(ordered, _borders(ordered, strip), strip)
    below = Window.partitionBy("conv_id").orderBy(F.desc("strip")).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(totals, ["strip", "conv_id"], "left").select(
        *rows.columns, *(F.coalesce(F.sum(f"t_{x}").over(below), F.lit(0)).alias(f"x_{x}") for x in ("saved", "leaves")))


def _ends(parts: DataFrame) -> DataFrame:
    """Digest of the ids that end at each open node; ids come partition by partition and are hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]]),
                                               pa.array([digest.hexdigest()])], ["end_depth", "end_key", "ends_sha256"])

        for batch in batches:
            for depth, key, ids in zip(*(batch.column(n).to_pylist() for n in ("depth", "key", "ids")), strict=True):
                if (depth, key) != node:
                    if node is not None:
                        yield done()
                    node, digest = (depth, key), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if node is not None:
            yield done()

    rows = parts.where("ids is not null").select("depth", "key", "pid", "ids").repartition("depth", "key")
    return rows.sortWithinPartitions("depth", "key", "pid").mapInArrow(
        run, "end_depth long, end_key string, ends_sha256 string")


def trie(strips: DataFrame, strip: int = STRIP) -> DataFrame:
    """One row per distinct prefix: conv_id (its least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    ordered = _sorted(_with_lower_totals(written(strips, "strips"), strip))
    borders = _borders(ordered, strip)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        first, following = borders.get(pid, (-1, -1))
        made = forest(Slice(batches, strip, first, following), strip, first, following, pid)
        kinds = [pa.int32(), *[pa.int64()] * 7, *[pa.string()] * 3, pa.int64(), pa.string(), pa.int32()]
        names = [f.split()[0] for f in NODE.split(", ")]
        for start in range(0, len(made), 10_000):
            columns = zip(*made[start:start + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    nodes = written(ordered.mapInArrow(run, NODE), "nodes")
    parts = nodes.where(F.col("kind") == OPEN)
    merged = written(parts.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.max("parent_key").alias("parent_key"), F.max("parent_conv_id").alias("known_id"),
        (F.sum("saved") - (F.sum("n_convs") - 1) * F.max("bytes_before")).alias("saved")), "merged")
    parents = broadcast_if_small(merged.select(
        (F.col("depth") + 1).alias("child_depth"), F.col("key").alias("upper_key"), F.col("conv_id").alias("upper_id")))
    beside = (F.col("depth") == F.col("child_depth")) & (F.col("parent_key") == F.col("upper_key"))
    columns = ["conv_id", "depth", F.col("parent_conv_id"), "n_convs", "n_children", "n_leaves",
               F.col("saved").alias("saved_tokens"), "ends_sha256"]
    whole = nodes.where(F.col("kind") == CLOSED)
    children = nodes.where(F.col("kind") == CHILD_OF_OPEN).drop("parent_conv_id").join(parents, beside)
    children = children.withColumn("parent_conv_id", F.col("upper_id"))
    opened = merged.join(parents, beside, "left").withColumn("parent_conv_id", F.coalesce("known_id", "upper_id")).join(
        _ends(parts), (F.col("depth") == F.col("end_depth")) & (F.col("key") == F.col("end_key")), "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    return whole.select(*columns).unionByName(children.select(*columns)).unionByName(opened.select(*columns))
