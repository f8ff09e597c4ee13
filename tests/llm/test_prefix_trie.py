"""Prefix trie against a plain trie, with long chains, hot conversations and edge rows."""

import hashlib
import random
import re
import zlib

import pytest

from cartwheel.llm import prefix_trie as pt
from cartwheel.llm.queries import QUERIES, op11_prefix_trie
from cartwheel.sources.tables import read_table

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [r[1:] for r in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = c % 20 if c >= 0 else -(-c % 20)  # the remainder of SQL
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
    out = set()
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children.get(node, [])),
                 leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run_rows(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in op11_prefix_trie(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def edge_rows():
    rows = [(None, 0, "user", "no id"), (0, None, "user", "null turn first"), (0, 4, None, None), (0, 5, "user", "a  b\tc")]
    rows += [(-3, 0, "user", "neg"), (-3, 1, "user", "neg"), (-3, 1, "user", "neg"), (40, 1, "s", ""), (45, 1, "s", "")]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"shared {t} words here") for c in range(60, 100) for t in range(c % 7)]
    rows += [(c, 0, "user", "one") for c in range(101, 125)]  # turnless or shortened ones among them
    return rows + [(200, 0, "user", "long word " * 100_000)]


def test_edge_rows(spark, tmp_path):
    rows = edge_rows()
    assert run_rows(spark, tmp_path, rows) == expected(rows)


def test_long_chains_are_split_by_spark_rounds(spark, tmp_path, monkeypatch, many_partitions):
    """A third of all turns in one conversation, deep branches, tiny tasks."""
    monkeypatch.setattr(pt.subtree_sums, "__defaults__", (25,))
    rng = random.Random(3)
    rows = [(20, t, "user", f"w {t}") for t in range(300)]
    rows += [(c, t, "user", f"w {t}" if t < cut else f"own {c} {t}") for c, cut, n in
             [(21 + i, rng.randrange(200), 20) for i in range(30)] for t in range(cut - 2 if cut > 2 else 0, cut + n)]
    rows += [(c, t, "user", f"w {t}" if t < 40 + c % 5 else f"x {c % 3} {t}") for c in range(400, 412) for t in range(50)]
    assert run_rows(spark, tmp_path, rows) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert run_rows(spark, tmp_path, []) == set()


def test_components_split_alike_whatever_the_task(spark):
    sf = "/root/testdata/sf0.01"
    rows = read_table(spark, sf, "conversations")
    turns = pt.rebuild_shared(pt.ordered_turns(rows))
    nodes, paths = pt.build_nodes(turns)
    whole = sorted(map(tuple, pt.subtree_sums(nodes, paths, ["words", "n_convs"]).collect()))
    small = sorted(map(tuple, pt.subtree_sums(nodes, paths, ["words", "n_convs"], task_weight=60).collect()))
    assert whole == small


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op11_prefix_trie"](spark, sf).collect()} == expected(rows)
