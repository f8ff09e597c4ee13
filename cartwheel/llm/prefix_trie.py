"""Prefix trie of conversations with a balanced rollup by centroid decomposition.

*Nodes.* Every distinct sequence of a conversation's first d turns (role, text)
is a node; its members are the conversations that begin with it, and its name is
(depth, smallest member). A prefix is identified by running sums, along the
conversation, of four 32-bit hashes of (position, role, text): the sums come from
one ordered scan, so a conversation that holds a third of all rows spans many
tasks. Members are counted by an aggregation with partial counts.

*Rollup.* Subtree sums follow the parent edges. Each node weighs as many rows as
it has members, so the weight below a node is known when the nodes are built:
the turns its members have from there on. Per round, every component of the
forest is split at its centroid, the deepest node that holds at least half of
the component's weight:

1. the totals of the nodes at and below the centroid are aggregated;
2. they are added to the centroid and to the component's nodes on the path from
   there to its top, which lose that weight;
3. the children's subtrees and what is left above become components.

Two nodes one above the other are parted by exactly one centroid, so each pair is
added once; no component keeps more than half its weight, so the rounds are
logarithmic however long a path is. Where a component has at most ``TASK_WEIGHT``
weight, one task finishes its recursion; larger ones are split by Spark jobs.

Nulls: a null role or text is empty, null turns come first, rows without ``conv_id``
take no part. Rows of one turn are ordered by role and hash of the text. Repeated
rows are turns of their own. An empty table has no node, not even a root. Other
input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import hash_pair, staged
from cartwheel.operators.relational import join_spread
from cartwheel.operators.scan import ordered_scan
from cartwheel.session import drop_staged

# Components up to this weight (turns of members) are finished inside a task.
TASK_WEIGHT = 4096

WORD = r"[^\x20\x09-\x0D]+"
SHARED = 3  # most turns a rebuilt conversation takes over
FAMILY = 20


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, role, h1, h2, words``: the conversations' turns numbered from
    0, a text as two hashes and its number of words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2 = hash_pair(text)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        h1.alias("h1"), h2.alias("h2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("turn").asc_nulls_first(), "role", "h1", "h2"]
    return ordered_scan(rows, "conv_id", order, position="pos").drop("turn")


def rebuild_shared(turns: DataFrame) -> DataFrame:
    """Conversations with shared beginnings: conversation c takes the first
    crc32(c) % 4 turns of conversation c - c % 20 (the remainder of SQL) in place
    of as many of its own. ``turns`` and the result have the columns of
    ``ordered_turns``; a conversation left without turns has one row with a null
    ``pos``."""
    kept = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    base = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv_id").alias("_base")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "role", "h1", "h2", "words"))).alias("_head"))  # at most SHARED
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", kept)
    convs = convs.join(base, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_base"), "left")
    convs = staged(convs.select("conv_id", "_n", "_h", F.slice("_head", F.lit(1), F.col("_h")).alias("_head"))
                   .withColumn("_got", F.coalesce(F.size("_head"), F.lit(0))), "trie-heads")
    short = convs.where(F.col("_got") < F.col("_h")).select("conv_id", "_n", (F.col("_h") - F.col("_got")).alias("_less"))
    own = turns.where(F.col("pos") >= kept)
    own = join_spread(own, short, ["conv_id"], "_n", turns.count(), "left")
    cols = ["conv_id", "pos", "role", "h1", "h2", "words"]
    own = own.withColumn("pos", F.col("pos") - F.coalesce("_less", F.lit(0)))
    taken = convs.where(F.col("_got") > 0).select("conv_id", F.explode("_head").alias("t")).select("conv_id", "t.*")
    bare = convs.where((F.col("_got") == 0) & (F.col("_n") <= F.col("_h"))) \
        .select("conv_id", *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in cols[1:]])
    return own.select(*cols).unionByName(taken.select(*cols)).unionByName(bare.select(*cols))


# -------------------------------------------------------------------- nodes
KEY = ["k0", "k1", "k2", "k3"]
NODE = ["depth", "conv_id"]


def _member_rows(turns: DataFrame) -> DataFrame:
    """A row per conversation and depth (0: the root): ``conv_id, depth``, the
    prefix keys, the words of its last text and the depth of its ``end``."""
    a, b = F.xxhash64("pos", "role", "h1"), F.xxhash64("role", "h2", "pos")
    low = F.lit(0xFFFFFFFF).cast("long")
    pieces = [a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32)]
    rows = turns.where(F.col("pos").isNotNull()).select("conv_id", (F.col("pos") + 1).alias("depth"), "words",
                                                        *[p.alias(f"x{i}") for i, p in enumerate(pieces)])
    sums = ordered_scan(rows, "conv_id", ["depth"], sums={f"x{i}": k for i, k in enumerate(KEY)}).select("conv_id", "depth", "words", *KEY)
    ends = turns.groupBy("conv_id").agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("end"))
    ends = staged(ends.withColumn("size", F.col("end")), "trie-ends")
    roots = ends.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"),
                        *[F.lit(0).cast("long").alias(k) for k in KEY], "end")
    return staged(join_spread(sums, ends, ["conv_id"], "size", sums.count()).unionByName(roots), "trie-rows")


def build_nodes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and paths of the trie over ``turns`` (columns of ``rebuild_shared``).

    Nodes: ``depth, conv_id, parent_conv_id, n_convs, words, weight`` (the
    turns, with the node's own, that its members have from here), ``n_children``.
    Paths: per conversation and depth the node's ``name``, its parent's name
    ``up`` and whether the conversation ``ends`` there."""
    rows = _member_rows(turns)
    nodes = staged(rows.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("name"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("end") - F.col("depth") + 1).alias("weight")), "trie-prefixes")
    names = nodes.select("depth", *KEY, "name", F.col("n_convs").alias("size"))
    named = staged(join_spread(rows, names, ["depth", *KEY], "size", rows.count())
                   .select("conv_id", "depth", "name", (F.col("depth") == F.col("end")).alias("ends")), "trie-names")
    above = named.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("up"))
    paths = staged(named.join(above, ["conv_id", "depth"], "left"), "trie-paths")
    # a node's name is a conversation that runs through it, so its parent is on that path
    parents = paths.where(F.col("conv_id") == F.col("name")).select("depth", "conv_id", F.col("up").alias("parent_conv_id"))
    found = staged(nodes.withColumnRenamed("name", "conv_id").join(parents, NODE)
                   .select(*NODE, "parent_conv_id", "n_convs", "words", "weight"), "trie-found")
    children = found.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    out = staged(found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    drop_staged(rows, nodes, named, found)
    return out, paths


# ------------------------------------------------------------------- rollup
def split_component(depth: list, name: list, up: list, weight: list, own: list[list]) -> list[list]:
    """Subtree sums of the columns ``own`` over one component, by recursion over
    its centroids. Nodes come by depth, the top first; ``up`` is the parent's
    name, ``weight`` the weight below and including the node."""
    at = {(d, c): i for i, (d, c) in enumerate(zip(depth, name))}
    parent = [None if i == 0 else at[depth[i] - 1, up[i]] for i in range(len(depth))]
    weight, sums = list(weight), [[0] * len(depth) for _ in own]
    todo = [list(range(len(depth)))]
    while todo:
        part = todo.pop()
        top = part[0]
        path = [i for i in part if 2 * weight[i] >= weight[top]]  # the centroid's path to the top
        g, cut = path[-1], weight[path[-1]]
        new_top: dict[int, int] = {}  # nodes below the centroid -> top of their new component
        above: list[int] = []
        below: dict[int, list[int]] = {}
        for i in part:
            if i == g:
                continue
            over = parent[i] if i != top else None
            if over == g or over in new_top:
                new_top[i] = i if over == g else new_top[over]
                below.setdefault(new_top[i], []).append(i)
            else:
                above.append(i)
        for column, s in zip(own, sums):
            total = column[g] + sum(column[i] for i in new_top)
            for i in path:
                s[i] += total
        for i in path:
            weight[i] -= cut if i != g else 0
        todo += [p for p in [above, *below.values()] if p]
    return sums


def _finish_in_tasks(state: DataFrame, values: list[str]) -> DataFrame:
    """``split_component`` over every component of ``state``, streamed one at a time."""
    names = [*NODE, *values]
    columns = ["top_depth", "top", *NODE, "up", "weight", *values, *["sum_" + v for v in values]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def finish() -> None:
            cols = list(zip(*held))
            sums = split_component(cols[2], cols[3], cols[4], cols[5], cols[6:6 + len(values)])
            totals = [[a + b for a, b in zip(s, before)] for s, before in zip(sums, cols[6 + len(values):])]
            out.extend(zip(cols[2], cols[3], *totals))

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if held and held[0][:2] != row[:2]:
                    finish()
                    held.clear()
                held.append(row)
            if len(out) > 10_000:
                yield emit()
                out.clear()
        if held:
            finish()
        yield emit()

    return state.select(*columns).repartition("top_depth", "top").sortWithinPartitions("top_depth", "top", *NODE) \
        .mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _split_round(state: DataFrame, paths: DataFrame, values: list[str], total: int) -> tuple[DataFrame, DataFrame]:
    """One round over all components of ``state`` by Spark jobs: the centroids with
    their final sums, and the nodes of the new components."""
    comp = ["top_depth", "top"]
    on_path = 2 * F.col("weight") >= F.col("total")  # the centroid and its path to the top
    cents = staged(state.where(on_path).groupBy(*comp).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("g"), F.max("total").alias("size"))
                   .select(*comp, "size", F.col("g.depth").alias("g_depth"), F.col("g.conv_id").alias("g_conv"), F.col("g.weight").alias("g_weight")),
                   "trie-centroids")
    at = staged(join_spread(state, cents, comp, "size", total), "trie-at")
    # all nodes of one name and component below the centroid's depth hang below the same node
    names = at.where(F.col("depth") > F.col("g_depth")).groupBy(*comp, "conv_id", "g_depth", "g_conv").agg(F.count(F.lit(1)).alias("size"))
    child = paths.select("conv_id", (F.col("depth") - 1).alias("g_depth"), F.col("name").alias("new_top"), F.col("up").alias("g_conv"))
    names = names.join(child, ["conv_id", "g_depth", "g_conv"])
    tops = at.where(F.col("depth") == F.col("g_depth") + 1).select(*comp, F.col("conv_id").alias("new_top"), F.col("weight").alias("new_total"))
    names = staged(names.join(tops, [*comp, "new_top"]).select(*comp, "conv_id", "size", "new_top", "new_total"), "trie-names-below")
    deep = F.col("depth") > F.col("g_depth")
    hung = staged(join_spread(at.where(deep), names, [*comp, "conv_id"], "size", total, "left").unionByName(at.where(~deep), allowMissingColumns=True),
                  "trie-hung")
    is_g = (F.col("depth") == F.col("g_depth")) & (F.col("conv_id") == F.col("g_conv"))
    under = is_g | F.col("new_top").isNotNull()
    totals = staged(hung.where(under).groupBy(*comp).agg(*[F.sum(v).alias("add_" + v) for v in values], F.max("total").alias("size")), "trie-totals")
    hung = join_spread(hung, totals, comp, "size", total)
    moved = hung.select(
        *NODE, "up", F.when(on_path & ~is_g, F.col("weight") - F.col("g_weight")).otherwise(F.col("weight")).alias("weight"), *values,
        *[F.when(on_path, F.col("sum_" + v) + F.col("add_" + v)).otherwise(F.col("sum_" + v)).alias("sum_" + v) for v in values],
        F.when(F.col("new_top").isNotNull(), F.col("g_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        F.coalesce("new_top", "top").alias("top"),
        F.coalesce("new_total", F.col("total") - F.col("g_weight")).alias("total"), is_g.alias("_g"))
    moved = staged(moved, "trie-state")
    drop_staged(cents, at, names, totals)
    return moved.where("_g"), moved.where("NOT _g").drop("_g")


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], task_weight: int = TASK_WEIGHT) -> DataFrame:
    """``depth, conv_id`` and the sums of the ``values`` columns over each node's
    subtree, the node included, by centroid decomposition. ``nodes`` has
    ``depth, conv_id, parent_conv_id, weight``, ``paths`` the conversations'
    ``conv_id, depth, name, up``."""
    zero = F.lit(0).cast("long")
    root = nodes.where(F.col("depth") == 0).agg(F.min("conv_id").alias("top"), F.max("weight").alias("total"))
    state = staged(nodes.select(*NODE, F.col("parent_conv_id").alias("up"), "weight", *[F.col(v).cast("long").alias(v) for v in values],
                                *[zero.alias("sum_" + v) for v in values], zero.alias("top_depth")).crossJoin(F.broadcast(root)), "trie-state")
    total = root.first()["total"] or 0
    done = []
    while True:
        large = state.where(F.col("total") > task_weight)
        small = state.where(F.col("total") <= task_weight)
        done.append(staged(_finish_in_tasks(small, values), "trie-sums"))
        if large.isEmpty():
            break
        centroids, state = _split_round(large, paths, values, total)
        done.append(centroids.select(*NODE, *[F.col("sum_" + v).alias(v) for v in values]))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def digest_ends(paths: DataFrame) -> DataFrame:
    """``depth, conv_id, sha256`` of the nodes where conversations end: the digest of
    those conversations' ids in order, comma-joined, streamed through the task."""
    rows = paths.where("ends").select("depth", "name", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, node = None, None
        done: list[tuple] = []

        def emit() -> pa.RecordBatch:
            cols = list(zip(*done)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()))],
                                              names=[*NODE, "sha256"])
        for batch in batches:
            for d, name, conv in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if node != (d, name):
                    if digest is not None:
                        done.append((*node, digest.hexdigest()))
                    digest, node = hashlib.sha256(str(conv).encode()), (d, name)
                else:
                    digest.update(f",{conv}".encode())
            yield emit()
            done = []
        if digest is not None:
            done = [(*node, digest.hexdigest())]
            yield emit()

    return rows.repartition("depth", "name").sortWithinPartitions("depth", "name", "conv_id") \
        .mapInArrow(run, "depth long, conv_id long, sha256 string")


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of ``turns`` (columns of ``ordered_turns``). Nodes: ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``; paths as in
    ``build_nodes``."""
    nodes, paths = build_nodes(turns)
    values = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")) \
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
    sums = subtree_sums(values, paths, ["n_leaves", "saved_tokens"])
    return nodes.join(sums, NODE).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), paths
