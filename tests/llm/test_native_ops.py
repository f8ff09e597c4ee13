"""Line dedup, source mixing and chat formatting: oracles, brute force, edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import chat_format, line_dedup, oracles, pfair_mix, queries
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert compare(got, duck(SF).execute(oracles.ORACLES[name]).df()) is None


# -- line dedup ---------------------------------------------------------------

def brute_lines(rows, min_docs):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or len(docs[key(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_brute_force(spark):
    rng = random.Random(1)
    pool = ["Common  line", "common  LINE", " common  line\t", "", "  ", "Ünique", "ünique", "ÜNIQUE", "tail", "x" * 5000]
    rows = [(i, "\n".join(rng.choice(pool) + (str(rng.randint(0, 9)) if rng.random() < .5 else "")
                          for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n"), (None, "Common  line"), (None, "common  line\nrest"), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_lines int, KEPT_text string")
    got = line_dedup.dedup_lines(df, min_docs=4).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_lines(rows, 4)


def test_line_dedup_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, extra string")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "extra", "n_lines", "n_dropped", "kept_text"] and out.count() == 0


def test_line_dedup_long_text(spark):
    text = "\n".join(["boiler", "unique"][i % 2] + ("" if i % 2 == 0 else str(i)) for i in range(40_000))
    df = spark.createDataFrame([(1, text), (2, "boiler")], "doc_id long, text string")
    r = {x.doc_id: x for x in line_dedup.dedup_lines(df, min_docs=2).collect()}
    assert r[1].n_lines == 40_000 and r[1].n_dropped == 20_000 and "boiler" not in r[1].kept_text
    assert r[2].kept_text == "" and r[2].n_dropped == 1


# -- mixing -------------------------------------------------------------------

@pytest.mark.parametrize("shares", [[1], [3, 2, 1], [5, 3, 3, 2], [12, 8, 8, 6, 6, 4, 4, 3, 13], [1, 1, 1, 97]])
def test_edf_deviates_less_than_a_block(shares):
    period, total, done = pfair_mix.edf_period(shares), sum(shares), [0] * len(shares)
    for t, i in enumerate(period, 1):
        done[i] += 1
        assert all(abs(d * total - n * t) < total for d, n in zip(done, shares))
    assert done == shares


def test_plan_keeps_every_row_and_less_than_a_block_per_phase():
    rng = random.Random(2)
    for _ in range(50):
        shares = {f"s{i}": rng.randint(1, 9) for i in range(rng.randint(1, 6))}
        rows = {s: rng.randint(0, 300) for s in shares}
        placed = defaultdict(list)
        for r in pfair_mix.plan_runs(rows, shares, 7):
            for b in range(r.first, r.last + 1):
                k = b - r.first
                slot = r.slot0 + k // r.share * r.period + r.slots[k % r.share]
                placed[slot].append((r.name, b, r.phase))
        assert all(len(v) == 1 for v in placed.values()) and sorted(placed) == list(range(len(placed)))
        blocks = Counter(v[0][0] for v in placed.values())
        assert blocks == {s: -(-n // 7) for s, n in rows.items() if n}
        # inside a phase every active class stays within one block of its share
        left = {s: -(-n // 7) for s, n in rows.items() if n}
        slot = 0
        while left:
            total, done, t = sum(shares[s] for s in left), Counter(), 0
            while all(done[s] < left[s] for s in left):
                name = placed[slot][0][0]
                done[name] += 1
                slot, t = slot + 1, t + 1
                assert all(abs(done[s] * total - shares[s] * t) < total for s in left)
            left = {s: n - done[s] for s, n in left.items() if n > done[s]}


def test_mix_positions_and_edge_rows(spark):
    rows = [(i, f"t{i}", "a" if i % 3 else "b") for i in range(500)]
    rows += [(None, "n1", None), (None, None, "a"), (7, "t7", "a"), (7, "t7", "a"), (900, "", "zzz")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, source string, mix_slot string")
    out = pfair_mix.mix_sources(df, {"a": 2, "b": 1, "unused": 5}, other_share=1, block_rows=4).toPandas()
    assert sorted(out["mix_position"]) == list(range(len(rows)))
    assert out["mix_class"].value_counts().to_dict() == {"a": 336, "b": 167, "(other)": 2}
    first = out.sort_values("mix_position").head(120)["mix_class"].value_counts()
    assert abs(first["a"] - 2 * first["b"]) <= 3 * 4
    empty = pfair_mix.mix_sources(df.limit(0), {"a": 1})
    assert empty.count() == 0 and "mix_position" in empty.columns
    with pytest.raises(ValueError):
        pfair_mix.mix_sources(df, {"a": 0})


def test_mix_spreads_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(pfair_mix, "ROWS_PER_BUCKET", 100)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit("x").alias("text"))
    out = pfair_mix.mix_sources(df, {"hot": 1}, block_rows=10)
    assert [r[0] for r in out.select("mix_position").orderBy("mix_position").collect()] == list(range(5000))


# -- chat formatting ----------------------------------------------------------

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def fold(spark, rows):
    out = chat_format.fold_events(spark.createDataFrame(rows, LOG))
    return sorted((r.conv_id, r.turn, r.msg_no, r.role, r.text) for r in out.collect())


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "helo"), (1, 1, 1, "message", "assistant", ""), (1, 2, 1, "delta", None, "par"),
        (1, 4, 1, "delta", None, "two"), (1, 3, 1, "delta", None, "t "), (1, 5, 0, "edit", None, "hello"),
        (1, 6, 2, "message", "user", "later"), (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", None, "new"),
        (1, 9, 2, "message", "user", "after"),
        (2, 0, 0, None, "user", None), (2, 0, 1, "delta", "assistant", "x"),
    ]
    assert fold(spark, rows) == [
        (1, 0, 1, "user", "hello"), (1, 1, 1, "assistant", "new"), (1, 2, 1, "user", "after"),
        (2, 0, 1, "user", ""), (2, 1, 0, "assistant", "x")]


def test_repeated_messages_stay(spark):
    rows = [(1, 0, 0, "message", "user", "a")] * 3
    assert [r[4] for r in fold(spark, rows)] == ["a", "a", "a"]


NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\", "[\\INST]", "<\\|im_end|>", "<|im_end|>\n<|im_start|>user\nhi", "<<SYS>>x<</SYS>>",
         "<<s>>", "[[INST]]", "<\\\\s>", "%0A%25", "a\n\n", "\n", "", "ü🙂<s>🙂", "<|im_start|>", "x" * 30_000 + "<s>"]


def test_escape_round_trip_and_no_control_left(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for r in df.select("t", chat_format.escape(F.col("t")).alias("e"), chat_format.unescape(chat_format.escape(F.col("t"))).alias("u"),
                       chat_format.unescape_role(chat_format.escape_role(F.col("t"))).alias("r")).collect():
        assert r.u == r.t and r.r == r.t
        assert not any(c in r.e for c in chat_format.CONTROL)


def test_render_and_read_back(spark):
    rng = random.Random(3)
    conv = [(c, t, rng.choice(["user", "assistant", "system", None, "we<ird\n%"]), rng.choice([*NASTY, None]))
            for c in [1, 2, 3, None] for t in range(8)]
    df = spark.createDataFrame(conv, "conv_id long, turn long, role string, text string")
    out = chat_format.read_back(chat_format.format_conversations(chat_format.messages_as_events(df))).collect()
    assert len(out) == 4
    for r in out:
        own = [x for x in conv if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert r.loss_texts == [x[3] or "" for x in own if x[2] == "assistant"]
        assert "".join(s.text for s in r.segments) == r.formatted


def test_chat_empty_log(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_conversations(chat_format.messages_as_events(df)).count() == 0


def test_control_conversation_digest(spark):
    r = queries.op8_chat_format(spark, SF).where("conv_id = -1").first()
    text = queries.CONTROL_TEXT
    assert r.n_turns == 2 and r.loss_chars == len(text)
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
