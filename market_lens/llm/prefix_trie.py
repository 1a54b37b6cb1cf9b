"""Prefix trie of conversations, built as adaptive radix trees over turn ids.

A turn's id is 16 bytes, big-endian: a digest of role and text, so texts are read once and never
shuffled. A conversation's key is its ids in order. Equal keys are one row with a count; rows are
sorted by key and cut into ranges, and a task builds the radix tree of its range: inner nodes have
4, 16, 48 or 256 places and grow, shared bytes are compressed into a node's path. Only byte
depths that are whole turns give trie nodes.

A trie node that lies in one range is finished there. The nodes on the path between two ranges
are shared: each range adds up what it alone sees (a child where it first appears, a leaf where it
is last seen, a text's bytes once), so their sums are the whole answer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_lens.llm.common import tasks
from market_lens.sources.scratch import materialize

WIDTH = 16
#: Distinct conversations of a range; a task builds the tree of one.
UNIT = 20_000
#: Ranges are cut by so many turns; a conversation may be longer.
SORTED_TURNS = 256
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_ZERO_DIGEST = hashlib.md5(b"").hexdigest()


class Node:
    """An inner place of the tree: ``path`` ends at byte ``end``; children by the next byte.

    Children lie in the smallest of four layouts: up to 4 and up to 16 as sorted bytes beside a
    list, up to 48 through an index of 256 bytes, beyond that in a list of 256.
    """

    __slots__ = ("children", "end", "first", "index", "kind", "last", "low", "row")

    def __init__(self, low: int, end: int, first: int):
        self.low, self.end = low, end  # the path is the key's bytes low..end of any row below
        self.first = self.last = first
        self.row = -1  # the row whose key ends here
        self.kind, self.index, self.children = 4, bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.kind <= 16:
            place = self.index.find(byte)
            return self.children[place] if place >= 0 else None
        if self.kind == 48:
            place = self.index[byte]
            return self.children[place - 1] if place else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add or replace the child of a byte; a full layout grows into the next one."""
        if self.kind <= 16:
            place = self.index.find(byte)
            if place >= 0:
                self.children[place] = child
                return
            if len(self.index) < self.kind:
                place = sum(b < byte for b in self.index)
                self.index.insert(place, byte)
                self.children.insert(place, child)
                return
            if self.kind == 4:
                self.kind = 16
            else:
                index = bytearray(256)
                for place, b in enumerate(self.index):
                    index[b] = place + 1
                self.kind, self.index = 48, index
            self.put(byte, child)
        elif self.kind == 48:
            if self.index[byte]:
                self.children[self.index[byte] - 1] = child
            elif len(self.children) < 48:
                self.children.append(child)
                self.index[byte] = len(self.children)
            else:
                wide: list[Node | None] = [None] * 256
                for b, place in enumerate(self.index):
                    if place:
                        wide[b] = self.children[place - 1]
                self.kind, self.index, self.children = 256, bytearray(), wide
                self.children[byte] = child
        else:
            self.children[byte] = child

    def ordered(self) -> list[Node]:
        if self.kind <= 16:
            return self.children
        if self.kind == 48:
            return [self.children[place - 1] for place in self.index if place]
        return [c for c in self.children if c is not None]


def common(a: bytes, b: bytes, start: int, end: int) -> int:
    """Up to where ``a`` and ``b`` are equal, from ``start`` on; compared in growing steps."""
    step = 64
    while start < end:
        stop = min(end, start + step)
        if a[start:stop] == b[start:stop]:
            start, step = stop, 2 * step
        elif stop - start <= 8:
            while a[start] == b[start]:
                start += 1
            return start
        else:
            end, step = stop, max(8, (stop - start) // 2)
    return end


def tree(keys: list[bytes]) -> Node:
    """The adaptive radix tree of distinct keys."""
    root = Node(0, len(keys[0]), 0)
    root.row = 0
    for row in range(1, len(keys)):
        key, node, parent = keys[row], root, None
        while True:
            path = keys[node.first]
            same = common(path, key, node.low, min(node.end, len(key)))
            if same < node.end:  # the path splits
                above = Node(node.low, same, node.first)
                above.last = row
                node.low = same
                above.put(path[same], node)
                if same == len(key):
                    above.row = row
                else:
                    leaf = Node(same, len(key), row)
                    leaf.row = row
                    above.put(key[same], leaf)
                if parent is None:
                    root = above
                else:
                    parent.put(key[above.low], above)
                break
            node.last = row
            if same == len(key):
                node.row = row
                break
            child = node.get(key[same])
            if child is None:
                leaf = Node(same, len(key), row)
                leaf.row = row
                node.put(key[same], leaf)
                break
            parent, node = node, child
    return root


_OUT = (
    "open boolean, digest string, parent_digest string, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens decimal(38,0), ends string"
)


def _digests(key: bytes, turns: int, width: int) -> list[str]:
    """Digests of a key's first 0, 1, … turns."""
    running, out = hashlib.md5(), [_ZERO_DIGEST]
    for d in range(turns):
        running.update(key[d * width : (d + 1) * width])
        out.append(running.copy().hexdigest())
    return out


def emitted(keys: list[bytes], sizes: list[np.ndarray], counts: list[int], lowest: list[int], before: int, after: int, width: int = WIDTH) -> list[tuple]:
    """Trie nodes of a range, as rows of the intermediate table.

    ``keys`` are distinct and sorted, with the bytes of their turns' texts, how many conversations have
    them and the smallest of these. ``before`` is how many turns the first key shares with the last key of the
    range before (-1: there is none), ``after`` the same on the other side.
    """
    root = tree(keys)
    last = len(keys) - 1
    order, stack = [], [root]
    above: dict[int, Node | None] = {id(root): None}
    while stack:
        node = stack.pop()
        order.append(node)
        for child in node.ordered():
            above[id(child)] = node
            stack.append(child)

    def depths(node: Node) -> range:
        """The whole turns that end on a node's path."""
        start = 0 if above[id(node)] is None else node.low // width + 1
        return range(start, node.end // width + 1)

    # From the leaves up: conversations, the smallest one, leaves, saved bytes, children of the turn above.
    n, low, leaves, saved, tops = {}, {}, {}, {}, {}
    results: list[tuple] = []
    for node in reversed(order):
        i, children = id(node), node.ordered()
        n[i] = (counts[node.row] if node.row >= 0 else 0) + sum(n[id(c)] for c in children)
        low[i] = min([lowest[node.row]] * (node.row >= 0) + [low[id(c)] for c in children])
        leaf, save, top = (sum(kind[id(c)] for c in children) for kind in (leaves, saved, tops))
        size = sizes[node.first]
        for d in reversed(depths(node)):
            seen = node.first == 0 and d <= before  # in an earlier range
            goes_on = node.last == last and d <= after
            if top == 0 and not children and d * width == node.end and not goes_on:
                leaf += 1
            if d:
                save += n[i] * int(size[d - 1]) - (0 if seen else int(size[d - 1]))
            results.append((node, d, n[i], low[i], top, leaf, save, seen or goes_on))
            top = 0 if seen else 1
        leaves[i], saved[i], tops[i] = leaf, save, top
    # Paths shared with the neighbours have names; within the range a parent is known by itself.
    left = _digests(keys[0], max(0, before), width)
    right = _digests(keys[-1], max(0, after), width)

    def name(node: Node, d: int) -> str:
        return left[d] if node.first == 0 and d < len(left) and d <= before else right[d]

    def upper(node: Node, d: int) -> Node:
        """Where the turn before lies."""
        while (d - 1) not in depths(node):
            node = above[id(node)]
        return node

    def is_open(node: Node, d: int) -> bool:
        return node.first == 0 and d <= before or node.last == last and d <= after

    rows = []
    for node, d, count, smallest, children, leaf, save, shared in results:
        parent = parent_name = None
        if d:
            home = upper(node, d)
            if is_open(home, d - 1):
                parent_name = name(home, d - 1)
            else:
                parent = low[id(home)]
        ends = hashlib.md5(keys[node.row]).hexdigest() if node.row >= 0 and d * width == node.end else None
        rows.append((shared, name(node, d) if shared else None, parent_name, smallest, d, parent, count, children, leaf, save, ends))
    return rows


def turn_id(role: Column, text: Column, width: int = WIDTH) -> Column:
    """A digest of the two strings; the role's length keeps them apart."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(both, 256), 1, 2 * width))


_KEYS = "conv_id long, key binary, sizes binary"


def keyed(turns: DataFrame) -> DataFrame:
    """``conv_id, key, sizes`` of every conversation of ``conv_id, turn, role, text``; sizes are 8 bytes a turn."""
    return _joined(_thin(turns), None)


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """The same, but each conversation c starts with the first h turns of conversation c - c % ``group`` (h is the
    crc32 of c in decimals modulo ``most``) and goes on with its own after its first h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    return _joined(_thin(turns).withColumn("h", h.cast("int")), group)


def _thin(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long").alias("size")
    rows = turns.where("conv_id is not null")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(role, text).alias("id"), size)


def _joined(thin: DataFrame, group: int | None) -> DataFrame:
    """Keys from thin rows: a group of conversations streams through a task, its first one ahead."""
    base = F.col("conv_id") - F.col("conv_id") % group if group else F.col("conv_id")
    rows = thin.withColumns({"base": base, "other": base != F.col("conv_id")})
    if group is None:
        rows = rows.withColumn("h", F.lit(0))
    rows = rows.repartition(tasks(thin), "base").sortWithinPartitions("base", "other", "conv_id", "turn", "id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("base", "conv_id", "h", "id", "size")
        most = 1 << 16  # more turns than any h
        current, own_base, head, head_sizes = None, None, b"", b""
        key, sizes, skip = bytearray(), bytearray(), 0
        done: list[tuple] = []
        held = 0

        def close() -> None:
            nonlocal head, head_sizes
            ids, bytes_ = bytes(key), bytes(sizes)
            if current == own_base:  # the group's first: its own turns come back whole
                head, head_sizes = ids[: WIDTH * most], bytes_[: 8 * most]
                done.append((current, ids, bytes_))
            else:
                h = min(skip, len(head) // WIDTH)
                done.append((current, head[: WIDTH * h] + ids[WIDTH * skip :], head_sizes[: 8 * h] + bytes_[8 * skip :]))

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
            for base, conv, h, turn, size in zip(*columns, strict=True):
                if conv != current:
                    if current is not None:
                        close()
                        held += len(key)
                    if base != own_base:
                        own_base, head, head_sizes = base, b"", b""
                    current, skip = conv, h
                    key, sizes = bytearray(), bytearray()
                    if held > 1 << 20:
                        yield _key_rows(done)
                        done, held = [], 0
                key += turn
                sizes += size.to_bytes(8, "big")
        if current is not None:
            close()
        if done:
            yield _key_rows(done)

    return rows.select("base", "conv_id", "h", "id", "size").mapInArrow(join, _KEYS)


def _key_rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["conv_id", "key", "sizes"])


def _ranges(distinct: DataFrame, unit: int) -> DataFrame:
    """Distinct keys in ranges ``part``, each of at most about ``unit`` of them."""
    spark = distinct.sparkSession
    n = max(1, math.ceil(distinct.count() / unit))
    head = F.substring("key", 1, WIDTH * SORTED_TURNS)
    parted = distinct.withColumn("head", head).repartitionByRange(n, "head").drop("head")
    return materialize(parted.withColumn("part", F.spark_partition_id()), "trie_ranges")


def _edges(parted: DataFrame) -> dict[int, tuple[int, int]]:
    """How many turns the first and last key of each range share with the neighbours; a pair of numbers for each range."""
    ends = parted.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    order = Window.orderBy("part")  # a row for each range
    pairs = ends.select("part", "first", F.lag("last").over(order).alias("earlier"))

    @F.arrow_udf("long")
    def shared(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip((v.as_py() for v in a), (v.as_py() for v in b), strict=True)
        return pa.array([-1 if x is None else common(x, y, 0, min(len(x), len(y))) // WIDTH for x, y in pairs], pa.int64())

    rows = pairs.select("part", shared("earlier", "first").alias("before")).collect()
    before = {r["part"]: r["before"] for r in sorted(rows)}
    parts = list(before)
    return {p: (before[p], before[parts[k + 1]] if k + 1 < len(parts) else -1) for k, p in enumerate(parts)}


def _member_digests(members: DataFrame) -> DataFrame:
    """``ends, ends_sha256``: per full key the digest of its conv_ids, ascending, joined by commas.

    Most keys have one conversation. The others' ids stream through a task in order: a
    digest is sequential, and only its state is held.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, hashlib.sha256(), []
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != current:
                    if current is not None:
                        out.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
        if current is not None:
            out.append((current, state.hexdigest()))
        for start in range(0, len(out), 10_000):
            some = out[start : start + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some)], ["ends", "ends_sha256"])

    rows = members.select("ends", "conv_id").repartition(tasks(members), "ends").sortWithinPartitions("ends", "conv_id")
    return rows.mapInArrow(stream, "ends string, ends_sha256 string")


def trie(keys: DataFrame, unit: int = UNIT) -> DataFrame:
    """The nodes of the prefix trie of conversations ``conv_id, key, sizes``.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. Members of a node are the conversations that start with its turns; the root has all of them and depth
    0. ``saved_tokens`` sums (members - 1) times the bytes of a node's last text over its subtree.

    A conversation without turns ends at the root. Without a conversation there is no node.
    """
    keys = materialize(keys, "trie_keys")
    same = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("sizes").alias("sizes"))
    same = materialize(same, "trie_keys")
    parted = _ranges(same, unit)
    edges = _edges(parted)

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        before, after = edges[rows["part"][0].as_py()]
        sizes = [np.frombuffer(s, ">i8") for s in rows["sizes"].to_pylist()]
        found = emitted(rows["key"].to_pylist(), sizes, rows["n"].to_pylist(), rows["conv_id"].to_pylist(), before, after)
        kinds = [pa.bool_(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.decimal128(38, 0), pa.string()]
        names = [c.split()[0] for c in _OUT.split(", ")]
        columns = list(zip(*found))
        columns[9] = [str(v) for v in columns[9]]
        arrays = [pa.array(c, pa.string()).cast(k) if k == kinds[9] else pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.table(arrays, names=names)

    spread = parted.repartition(max(1, len(edges)), "part")
    built = materialize(spread.groupBy("part").applyInArrow(build, _OUT), "trie_nodes")
    shared = built.where("open").groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("depth", "parent_digest")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"),
    )
    shared = materialize(shared, "trie_shared")
    named = shared.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    top = shared.where("parent_digest is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns)
    closed = built.where("not open")
    inner = closed.where("parent_digest is null").select(columns)
    below = shared.unionByName(closed.drop("open", "parent_conv_id")).join(named, "parent_digest")
    nodes = inner.unionByName(top).unionByName(below.withColumnRenamed("parent", "parent_conv_id").select(columns))

    alone = F.sha2(F.col("conv_id").cast("string"), 256)
    ended = F.md5("key").alias("ends")
    several = materialize(same.where("n > 1").select("key"), "trie_repeated")
    members = keys.join(several, "key").select(ended, "conv_id")
    digests = _member_digests(members).unionByName(same.where("n = 1").select(ended, alone.alias("ends_sha256")))
    done = nodes.where("ends is not null").join(digests, "ends").drop("ends")
    passed = nodes.where("ends is null").drop("ends").withColumn("ends_sha256", F.lit(_NO_ENDS))
    return done.unionByName(passed).withColumn("saved_tokens", F.col("saved_tokens").cast("long"))
