"""The prefix trie of conversations: which of them begin with the same turns, and what storing shared turns once would save.

A turn is 20 bytes: 16 of a SHA-256 over role and text, and the number of code points of the text. A conversation is the array of its
turns, one binary key. Conversations are range-sorted by (key, id) over the whole table, so a group of copies of any size is dealt
out over tasks. A task sweeps its stretch once, in order: the common prefix with the row before says how many open nodes of the stack
close, the others stay, and the rest of the row's turns open new ones.

Nodes on the path of a stretch's first or last row may go on in the next stretch. They leave the task as parts, named by a hash of their
prefix. The longest common prefix at each border then says which of a part's counts its neighbour has counted already, and parts of one
name are summed. All counts of a node are sums over its rows, so stitching is one aggregation. What hangs below an open node learns its
parent's smallest member by a join with the few open nodes.

A task holds the nodes of its own stretch, TURNS turns on average; no text is shuffled or held. The ids that end at a node come in
order; for an open node each stretch leaves its list as a piece, and one pass hashes the pieces of a node in order as they stream by.

Cases: rows without conv_id are dropped. Turns are ordered by turn, null first; turns with one number by role, then by hash. A repeated
row is a turn again. Null role or text is empty. A conversation that has no turn when rebuilt ends at the root. Negative ids
take conversation c - c % 100 with the remainder's sign of c. Other columns are not looked at. An empty table gives an empty
result, without a root."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table, bounded_batches, join_counted

#: Bytes of a turn in a key: hash and code points.
HASH, ENTRY = 16, 20
#: Turns in a stretch, on average.
TURNS = 200_000
GROUP, FORMS = 100, 6

#: What a task says of a node. open: a part of a node on the path of the first (left) or last (right) row; parent_id is null where the
#: parent is open. chars: code points of all turns from the root. ends: the ids that end here in this stretch, of an open node.
NODE = "pid int, depth long, conv_id long, parent_id long, name binary, parent_name binary, is_open boolean, is_left boolean, is_right boolean, n_convs long, n_children long, n_leaves long, saved long, size long, chars long, sha string, ends binary, first_key binary, last_key binary"
NAMES = [f.split(" ")[0] for f in NODE.split(", ")]
KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
ARROW = pa.schema([(f.split(" ")[0], KINDS[f.split(" ")[1]]) for f in NODE.split(", ")])
ROWS_OUT = 20_000


def turn_entry(role: Column, text: Column) -> Column:
    """A turn in hex; the role's length keeps role and text apart."""
    said = F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))
    return F.concat(F.substring(F.sha2(said, 256), 1, 2 * HASH), F.lpad(F.hex(F.length(text)), 8, "0"))


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns as a key."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", role.alias("role"), turn_entry(role, text).alias("entry")).alias("t"))
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["entry"])
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("own"))


def rebuilt(arrays: DataFrame) -> DataFrame:
    """conv_id and key: the first h turns of the conversation that opens the hundred, then the own turns after the first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % FORMS * ENTRY).cast("int")
    heads = arrays.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("head_id"), F.substring("own", 1, (FORMS - 1) * ENTRY).alias("head"))
    tagged = arrays.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head_id"), h.alias("h"))
    joined = join_counted(tagged, heads, ["head_id"], "left", F.octet_length("head"))
    head = F.coalesce(F.expr("substring(head, 1, h)"), F.lit(b""))
    return joined.select("conv_id", F.concat(head, F.expr("substring(own, h + 1)")).alias("key"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two keys begin with alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // ENTRY
    low, high = 0, most // ENTRY  # the first `low` turns agree, the first `high` don't
    while high - low > 1:
        half = (low + high) // 2
        low, high = (half, high) if a[low * ENTRY : half * ENTRY] == b[low * ENTRY : half * ENTRY] else (low, half)
    return low


def chars_at(key: bytes, depth: int) -> int:
    """Code points of the turn at a depth; 0 at the root."""
    return int.from_bytes(key[depth * ENTRY - (ENTRY - HASH) : depth * ENTRY], "big") if depth else 0


class Node:
    __slots__ = ("chars", "children", "conv_id", "depth", "ends", "leaves", "n", "parent", "saved", "size")

    def __init__(self, depth: int, size: int, chars: int, parent: Node | None):
        self.depth, self.size, self.chars, self.parent = depth, size, chars, parent
        self.conv_id, self.n, self.children, self.leaves, self.saved, self.ends = 1 << 63, 0, 0, 0, 0, []


def close(node: Node) -> None:
    """A node's own share of what is saved, and its sums to its parent."""
    node.saved += (node.n - 1) * node.size
    up = node.parent
    if up is not None:
        up.n += node.n
        up.leaves += node.leaves
        up.saved += node.saved
        up.children += 1
        up.conv_id = min(up.conv_id, node.conv_id)


def names_on(key: bytes) -> list[bytes]:
    """A hash of every prefix of a key."""
    state, out = hashlib.sha256(), [hashlib.sha256().digest()]
    for at in range(0, len(key), ENTRY):
        state.update(key[at : at + ENTRY])
        out.append(state.copy().digest())
    return out


def sweep(rows: Iterator[tuple[int, bytes]]) -> tuple[list[Node], bytes, bytes]:
    """All nodes of a sorted stretch, with its first and last key. The row after the stretch is taken to begin anew, as is the one before."""
    stack, nodes, first, last = [root := Node(0, 0, 0, None)], [root], b"", None
    for conv_id, key in rows:
        depth = len(key) // ENTRY
        same = 0 if last is None else common_turns(last, key)
        if last is None:
            first = key
        elif same < len(last) // ENTRY:  # nothing goes on from the row before
            stack[-1].leaves += 1
        while len(stack) - 1 > same:
            close(stack.pop())
        for d in range(same + 1, depth + 1):
            size = chars_at(key, d)
            stack.append(Node(d, size, stack[-1].chars + size, stack[-1]))
            nodes.append(stack[-1])
        top = stack[-1]
        top.n += 1
        top.conv_id = min(top.conv_id, conv_id)
        top.ends.append(conv_id)
        last = key
    if last is not None:
        stack[-1].leaves += 1
        while stack:
            close(stack.pop())
    return nodes, first, last or b""


def on_path(nodes: list[Node], key: bytes, first: bool) -> list[Node]:
    """The nodes of the first or last row's path, by depth."""
    depth, out = len(key) // ENTRY, [nodes[0]]
    if first:  # the first row opened them one after the other
        return nodes[: depth + 1]
    for node in reversed(nodes):  # the last nodes of each depth, as long as they are each other's parents
        if node.depth == depth:
            while node.parent is not None:
                out.insert(1, node)
                node = node.parent
            break
    return out


def records(nodes: list[Node], first: bytes, last: bytes, pid: int) -> Iterator[dict]:
    """NODE rows of a stretch."""
    left, right, names = set(), set(), {}
    for key, side, is_first in ((first, left, True), (last, right, False)):
        for node, name in zip(on_path(nodes, key, is_first), names_on(key), strict=True):
            side.add(id(node))
            names[id(node)] = name
    for node in nodes:
        me, up = id(node), node.parent
        ids = ",".join(map(str, node.ends)).encode()
        is_open, below_open = me in names, up is not None and id(up) in names
        yield {
            "pid": pid, "depth": node.depth, "conv_id": node.conv_id, "parent_id": None if up is None or below_open else up.conv_id, "name": names.get(me), "parent_name": names[id(up)] if below_open else None,
            "is_open": is_open, "is_left": me in left, "is_right": me in right, "n_convs": node.n, "n_children": node.children, "n_leaves": node.leaves, "saved": node.saved, "size": node.size, "chars": node.chars,
            "sha": None if is_open else hashlib.sha256(ids).hexdigest(), "ends": ids if is_open and ids else None, "first_key": first if up is None else None, "last_key": last if up is None else None,
        }


def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's rows, which are in order."""

    def rows() -> Iterator[tuple[int, bytes]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    nodes, first, last = sweep(rows())
    if nodes[0].n:
        held: list[dict] = []
        for r in records(nodes, first, last, TaskContext.get().partitionId()):
            held.append(r)
            if len(held) == ROWS_OUT:
                yield pa.RecordBatch.from_pylist(held, ARROW)
                held = []
        yield pa.RecordBatch.from_pylist(held, ARROW)


def borders(nodes: DataFrame) -> DataFrame:
    """For each stretch: `shared`, the turns that its first row shares with the row before it; `shared_chars`, their code points; `goes_on`,
    whether the row after it begins with its last row. A row for each stretch; their keys pass by one after the other."""
    order = Window.orderBy("pid")
    edges = nodes.where("depth = 0").select("pid", "first_key", F.lag("last_key").over(order).alias("before"), "last_key", F.lead("first_key").over(order).alias("after"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for e in f.itertuples(index=False):
                shared = 0 if e.before is None else common_turns(e.before, e.first_key)
                goes_on = e.after is not None and common_turns(e.last_key, e.after) * ENTRY >= len(e.last_key)
                out.append((e.pid, shared, sum(chars_at(e.first_key, d) for d in range(1, shared + 1)), goes_on))
            yield pd.DataFrame(out, columns=["pid", "shared", "shared_chars", "goes_on"])

    return edges.mapInPandas(run, "pid int, shared long, shared_chars long, goes_on boolean")


def stitched(nodes: DataFrame) -> DataFrame:
    """Open nodes: depth, name, parent_name and their sums over all stretches. A stretch's first row has opened again what the row before it had
    open, and its last row has ended what the next one goes on with."""
    parts = nodes.where("is_open").join(F.broadcast(as_table(borders(nodes), "borders")), "pid")  # a row for each stretch
    again = F.col("is_left") & (F.col("depth") <= F.col("shared"))
    size_before = F.col("chars") - F.col("size")
    known = parts.withColumns({
        "n_children": F.col("n_children") - (F.col("is_left") & (F.col("depth") < F.col("shared"))).cast("long"),
        "n_leaves": F.col("n_leaves") - (F.col("is_right") & F.col("goes_on")).cast("long"),
        "saved": F.col("saved") + F.when(again, F.col("shared_chars") - size_before).otherwise(0),
    })
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    return known.groupBy("depth", "name").agg(F.min("parent_name").alias("parent_name"), F.min("conv_id").alias("conv_id"), *sums)


def ends_of(nodes: DataFrame, partitions: int) -> DataFrame:
    """name, sha: the hash over the ids that end at each open node, whose pieces stream by in order."""
    pieces = nodes.where("is_open and ends is not null").select("name", "pid", "ends").repartition(partitions, "name").sortWithinPartitions("name", "pid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for n, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n != name:
                    if name is not None:
                        done.append((name, state.hexdigest()))
                    name, state = n, hashlib.sha256(piece)
                else:
                    state.update(b"," + piece)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["name", "sha"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["name", "sha"])

    return pieces.mapInArrow(run, "name binary, sha string")


def trie(conversations: DataFrame, turns: int = TURNS) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    keys = as_table(rebuilt(as_table(turn_arrays(conversations), "turns")), "keys")
    held = keys.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    stretches = max(1, -(-held // (ENTRY * turns)))
    ordered = keys.repartitionByRange(stretches, "key", "conv_id").sortWithinPartitions("key", "conv_id").select("conv_id", "key")
    nodes = as_table(ordered.mapInArrow(swept, NODE), "nodes")
    opened = stitched(nodes)
    empty = hashlib.sha256().hexdigest()
    opened = as_table(opened.join(ends_of(nodes, stretches), "name", "left"), "open")
    parents = opened.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("open_parent"))
    columns = ["conv_id", "depth", "parent_id", "parent_name", "n_convs", "n_children", "n_leaves", "saved", "sha"]
    both = nodes.where("not is_open").select(*columns).unionByName(opened.withColumn("parent_id", F.lit(None).cast("long")).select(*columns))
    below_open = join_counted(both.where("parent_name is not null"), parents, ["parent_name"], "inner", F.lit(HASH + ENTRY))
    found = below_open.unionByName(both.where("parent_name is null").withColumn("open_parent", F.lit(None).cast("long")))
    return found.select("conv_id", "depth", F.coalesce("parent_id", "open_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))
