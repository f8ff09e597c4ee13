"""Conversation repair against an exhaustive search, by parts, and on edge rows."""

import hashlib
import re
import zlib
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import turn_repair as tr
from cartwheel.llm.queries import QUERIES, op12_turn_repair
from cartwheel.sources.tables import read_table

WS = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """Plain version of the seeded damage on (conv, turn, role, text), in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        row = (turn, "user" if k == 4 else role, text)
        out += [row, row] if k == 3 else [row]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        left = text.rstrip(WS)
        out.append(tr.BLANK if not left else tr.DUPLICATE if (role, text) in seen
                   else tr.TRUNCATED if left[-1] not in ".!?" else tr.FINE)
        seen.add((role, text))
    return out


def forward_best(rows):
    """All undominated audits by plain dynamic programming from the front: per
    (row, state) the least (cost, audit), with up to two insertions anywhere."""
    def grow(found):
        for _ in range(3):
            for q, (cost, audit) in list(found.items()):
                for x in "ua":
                    r = tr.STEP[q].get(x)
                    if r is not None and (r not in found or (cost + 5, audit + "I") < found[r]):
                        found[r] = (cost + 5, audit + "I")
        return found
    found = grow({tr.EMPTY: (0, "")})
    for initial, fault in rows:
        after = {}
        for q, (cost, audit) in found.items():
            options = [(q, 2, "D")]
            if fault in (tr.FINE, tr.TRUNCATED):
                more = 5 if fault == tr.TRUNCATED else 0
                options += [(tr.STEP[q].get(initial), more, "K")] + [(tr.STEP[q].get(x), more + 1, "R") for x in "ua"]
            for r, c, e in options:
                if r is not None and (r not in after or (cost + c, audit + e) < after[r]):
                    after[r] = (cost + c, audit + e)
        found = grow(after)
    return min(found[q] for q in tr.FINAL if q in found)


def exhaustive(rows):
    """Every string of edits with at most one insertion at each of the first places."""
    best = None
    for letters in product("KRD", repeat=len(rows)):
        for gaps in product(range(3), repeat=len(rows) + 1):
            if sum(gaps) > 3:
                continue
            cost, fine = 5 * sum(gaps), True
            for (initial, fault), e in zip(rows, letters):
                fine &= e == "D" or fault not in (tr.BLANK, tr.DUPLICATE) and (e == "R" or initial != "")
                cost += tr.COST[e] + (5 if e != "D" and fault == tr.TRUNCATED else 0)
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(letters, gaps[1:]))
            if not fine or (best is not None and (cost, audit) >= best):
                continue
            slots, it = [], iter(rows)
            for e in audit:
                initial = next(it)[0] if e != "I" else None
                if e != "D":
                    slots.append([initial] if e == "K" else ["u", "a"])
            if any(LEGAL.match("".join(w)) for w in product(*slots)):
                best = (cost, audit)
    return best


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.integers(0, 3)), max_size=4)


@settings(max_examples=60, deadline=None)
@given(ROWS)
def test_agenda_equals_exhaustive_search(rows):
    cost, _, audit = tr.derive_whole(rows)
    assert (cost, audit) == exhaustive(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t"]), st.integers(0, 3)), max_size=25), st.data())
def test_parts_joined_anywhere_give_the_whole(rows, data):
    cuts = sorted(data.draw(st.lists(st.integers(0, len(rows)), max_size=3)))
    whole = tr.derive_whole(rows)
    assert (whole[0], whole[2]) == forward_best(rows)
    spans = {(q, q): (0, 0, "") for q in tr.STATES}
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spans = tr.join_spans(spans, tr.derive_part(rows[a:b]))
    assert min(w for (q, r), w in spans.items() if q == tr.EMPTY and r in tr.FINAL) == whole


def repaired_lines(rows, audit):
    out, it, state = [], iter(rows), tr.EMPTY
    for e in audit:
        row = None if e == "I" else next(it)
        if e == "D":
            continue
        x = row[1][:1] if e == "K" else "a" if state == tr.USER else "u"
        out.append(f"{row[1]}:{row[2]}" if e == "K" else f"{tr.ROLES[x]}:{'' if row is None else row[2]}")
        state = tr.STEP[state][x]
    return out


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        fault = faults(mine)
        initials = [r[1][:1] for r in mine]
        turns = {r[0] for r in mine if r[0] is not None}
        cost, audit = forward_best(list(zip(initials, fault))) if mine else (0, "")
        text = "\n".join(repaired_lines(mine, audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(k) for k in (1, 2, 3)),
                     sum(a + b not in tr.LEGAL_PAIRS for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def run_rows(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in op12_turn_repair(spark, str(tmp_path)).collect()}


def edge_rows():
    rows = [(None, t, "user", f"nameless {t}.") for t in range(4)]
    rows += [(-3, None, "user", "no turn."), (-3, 5, None, "x."), (-3, 9, "assistant", None), (-3, 10, "", "empty role!")]
    rows += [(7, t, r, "same text.") for t, r in enumerate(["system", "user", "user", "user", "assistant", "tool"])]
    rows += [(8, 1, "user", "twice."), (8, 1, "user", "twice."), (8, 1, "assistant", "tie?"), (9, 3, "assistant", " \n\t")]
    rows += [(c, t, ["user", "assistant", "system", "user"][(c * t + t) % 4], f"text {c} {t % 5}{'.' if t % 3 else ' '}")
             for c in range(20, 60) for t in range(c % 9)]
    return rows + [(10, 0, "user", "long. " * 200_000)]


def test_query_equals_brute_force_on_edge_rows(spark, tmp_path):
    rows = edge_rows()
    assert run_rows(spark, tmp_path, rows) == expected(rows)


def test_a_conversation_over_many_partitions(spark, tmp_path, monkeypatch):
    """A third of all rows in one conversation, cut into parts and pieces."""
    monkeypatch.setattr(tr, "PIECE_ROWS", 5)
    rows = [(1, t, ["user", "assistant", "assistant", "user", "system"][t * t % 5], f"t{t % 150}{'.' if t % 4 else ''}") for t in range(400)]
    rows += [(c, t, "assistant" if t % 2 else "user", f"hello {c} {t}.") for c in range(2, 130) for t in range(6)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run_rows(spark, tmp_path, rows) == expected(rows)
        marked = tr.mark_faults(read_table(spark, str(tmp_path), "conversations")).repartitionByRange(*tr._order("fault"))
        assert marked.where("conv_id = 1").select(F.spark_partition_id()).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table(spark, tmp_path):
    assert run_rows(spark, tmp_path, []) == {}


def test_repaired_rows_and_ignored_columns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "A?"), (1, 2, "user", "A?"), (2, 0, "user", "Only.")]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, audit int, cost int")
    plans = tr.plan_repairs(turns)
    assert {r.conv_id: (r.cost, r.audit) for r in plans.collect()} == {1: (4, "RRD"), 2: (2, "D")}
    out = tr.apply_repairs(turns, plans).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in out] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "A?")]


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_turn_repair"](spark, sf).collect()} == expected(rows)
