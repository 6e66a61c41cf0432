"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets, numbered, skewed_join, text_key, written

#: Rows of the packing plan up to which it is broadcast (about 30 bytes each).
MOST_BROADCAST = 200_000


class _Node:
    __slots__ = ("height", "key", "left", "right")

    def __init__(self, key: tuple[int, int]):
        self.key, self.left, self.right, self.height = key, None, None, 1


class Bins:
    """Bins in a height-balanced (AVL) search tree by (remaining capacity, bin): putting one in and taking out
    the tightest that fits cost a path of at most 1.44 log2(bins) nodes."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def put(self, remaining: int, which: int) -> None:
        self.root = _put(self.root, (remaining, which))

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin with the least remaining capacity that still holds ``size``."""
        node, found = self.root, None
        while node:
            if node.key[0] >= size:
                node, found = node.left, node.key
            else:
                node = node.right
        if found is not None:
            self.root = _take(self.root, found)
        return found


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _turned(node: _Node, up: str, down: str) -> _Node:
    """The child on side ``up`` becomes the root of ``node``'s subtree."""
    child = getattr(node, up)
    setattr(node, up, getattr(child, down))
    setattr(child, down, node)
    node.height = 1 + max(_height(node.left), _height(node.right))
    child.height = 1 + max(_height(child.left), _height(child.right))
    return child


def _balanced(node: _Node) -> _Node:
    """``node``'s subtree with sides that differ by one level at most."""
    lean = _height(node.left) - _height(node.right)
    if abs(lean) <= 1:
        node.height = 1 + max(_height(node.left), _height(node.right))
        return node
    high, low = ("left", "right") if lean > 1 else ("right", "left")
    child = getattr(node, high)
    if _height(getattr(child, low)) > _height(getattr(child, high)):
        setattr(node, high, _turned(child, low, high))
    return _turned(node, high, low)


def _put(node: _Node | None, key: tuple[int, int]) -> _Node:
    if node is None:
        return _Node(key)
    side = "left" if key < node.key else "right"
    setattr(node, side, _put(getattr(node, side), key))
    return _balanced(node)


def _take(node: _Node, key: tuple[int, int]) -> _Node | None:
    if key != node.key:
        side = "left" if key < node.key else "right"
        setattr(node, side, _take(getattr(node, side), key))
        return _balanced(node)
    if node.left is None or node.right is None:
        return node.left or node.right
    after = node.right
    while after.left:
        after = after.left
    node.key, node.right = after.key, _take(node.right, after.key)
    return _balanced(node)


@dataclass(frozen=True)
class Run:
    """``count`` groups of ``size``, from the ``first``-th group of that size on, in bin ``shard``."""

    size: int
    first: int
    count: int
    shard: int


def pack(classes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[Run] | None:
    """Best-fit-decreasing over size classes ``(size, number of groups)``, given by falling size.

    Groups of one size are placed in bulk: the tightest bin stays the tightest while it still fits, so
    it takes as many as it holds. That is step for step the one-by-one result. A group larger than
    ``capacity`` gets a bin of its own. None if more than ``most`` bins would be needed.
    """
    bins, runs, opened = Bins(), [], 0
    for size, count in classes:
        first = 0
        while first < count:
            found = bins.tightest(size)
            if found is None:
                if most is not None and opened == most:
                    return None
                found = (max(capacity, size), opened)
                opened += 1
            remaining, which = found
            n = min(count - first, remaining // size)
            runs.append(Run(size, first, n, which))
            bins.put(remaining - n * size, which)
            first += n
    return runs


def pack_evenly(classes: list[tuple[int, int]], shards: int) -> list[Run]:
    """``shards`` bins of near equal bytes: groups above the mean of what is left get bins of their own,
    then the least capacity is bisected for which best-fit-decreasing needs no more bins than are left."""
    left = [list(c) for c in classes]
    total = sum(s * n for s, n in classes)
    own: list[Run] = []
    free = shards
    while left and free > 1 and left[0][0] * free > total:
        size, count = left[0]
        own.append(Run(size, classes[len(classes) - len(left)][1] - count, 1, shards - free))
        total -= size
        free -= 1
        left[0][1] -= 1
        if not left[0][1]:
            left.pop(0)
    if not left:
        return own
    rest = [(s, n) for s, n in left]
    low, high = max(-(-total // free), rest[0][0]) - 1, total
    best = pack(rest, high, free)
    while high - low > 1:
        middle = (low + high) // 2
        tried = pack(rest, middle, free)
        if tried is None:
            low = middle
        else:
            high, best = middle, tried
    done = classes[len(classes) - len(left)][1] - left[0][1]  # groups of the first class that have bins already
    return own + [Run(r.size, r.first + done * (r.size == rest[0][0]), r.count, r.shard + shards - free) for r in best]


def shard_documents(
    docs: DataFrame, shards: int | None = 16, capacity: int | None = None, order: tuple[Column, Column] | None = None
) -> DataFrame:
    """Every row of ``docs`` with its shard; rows with equal text are one indivisible group.

    Size is the UTF-8 bytes of the text plus 1 (null text: 1; its checksum is that of no bytes). Null
    text is a group of its own. With ``capacity`` the number of shards is what best-fit-decreasing needs;
    else ``shards`` bins get near equal bytes. Ties of size go by text key; repeated rows are rows of
    their own; an empty table gives no rows; further columns are ignored, whatever their names. Returns
    doc_id, size, text_crc32, shard, slot, text_key.

    Slots follow ``order`` (range, place in the range; a range is numbered in one task) where it is given,
    else a hash. Texts stay where they are read: only (key, size) moves. The driver sees the histogram of
    group sizes. Sizes are distinct, so it has at most sqrt(2 * total bytes) entries whatever the corpus.
    """
    n = buckets(docs.sparkSession)
    where = order or (F.lit(0), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit("null")).otherwise(text_key(F.col("text"))).alias("text_key"),
        where[0].alias("o_range"), where[1].alias("o_place"),
    )
    rows = written(rows)
    groups = written(rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("one")))
    groups = groups.select("text_key", (F.col("n") * F.col("one")).alias("group_size"))
    sizes = written(groups.groupBy("group_size").agg(F.count(F.lit(1)).alias("_n")))
    classes = sorted(((r[0], r[1]) for r in sizes.toLocalIterator()), reverse=True)
    runs = (pack(classes, capacity) if capacity else pack_evenly(classes, shards)) or []
    plan = docs.sparkSession.createDataFrame(_table(runs))
    ranked = numbered(groups, ["group_size"], ["text_key"], "rank", F.col("text_key"), n)
    if len(runs) <= MOST_BROADCAST:
        met = ranked.join(F.broadcast(plan), "group_size")
    else:  # the same rows by sort-merge, where a size of many groups is split
        met = skewed_join(written(ranked), plan, "group_size")
    placed = met.filter(F.col("rank").between(F.col("run_first"), F.col("run_end") - 1)).select("text_key", "shard")
    sharded = written(skewed_join(rows, placed, "text_key"))
    if order:
        out = numbered(sharded, ["shard"], ["o_place", "doc_id", "text_key"], "slot", F.lit(0), 1, ranges=F.col("o_range"))
    else:
        out = numbered(sharded, ["shard"], ["doc_id"], "slot", F.struct("doc_id", "text_key"), 4 * n)
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", "text_key")


def _table(runs: list[Run]):
    """The plan as an Arrow table, which Spark takes over in batches."""
    import pyarrow as pa

    columns = ([r.size for r in runs], [r.first for r in runs], [r.first + r.count for r in runs], [r.shard for r in runs])
    kinds = {"group_size": pa.int64(), "run_first": pa.int64(), "run_end": pa.int64(), "shard": pa.int32()}
    return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, kinds.items(), strict=True)})
