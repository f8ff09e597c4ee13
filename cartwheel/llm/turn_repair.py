"""Repair of a conversation's structure by lightest derivations.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``:
maybe a system turn, then user and assistant in turns, or nothing at all. Edits
on its rows in order: Keep costs 0; Rerole to user or assistant 1; Delete 2 (the
only edit of a blank or repeated row); Insert an empty user or assistant turn 5;
a truncated row that isn't deleted adds 5. The audit is the string of the edits'
initials. Wanted is the cheapest audit, the ASCII-least one among equals.

*Deduction system.* Items: ``row i edited to symbol x``, ``inserted symbol x``, and
``rows i.. lead from state q to state r``. Hyperedges join an edited row or an
insertion with a suffix item: (cost, rows, audit) are added and concatenated.
Knuth's agenda pops items in the order of (cost, rows, audit); a popped item is
final, and the run ends when the goal pops. The function is monotone on both
sides: two derivations of one item with equal cost have the same number of
row letters, and one can't be a proper prefix of the other, as the letters
beyond it would be insertions, which cost. It is superior because each
hyperedge adds cost or a row (the row count of an item is fixed, so the least
(cost, rows, audit) of an item is its least (cost, audit)).

*Scale.* Rows travel as a few numbers, sorted over range partitions, so a
conversation that holds a third of all rows spans many tasks. A conversation
that lies inside one partition is solved there; otherwise each part gives the
lightest derivation between every pair of states, and the parts are joined in
order (again hyperedges, part by part). Parts are derived ``PIECE_ROWS`` rows at a
time. Only a conversation's audit string, which is a cell of the result, has to
fit a task; texts are streamed past it.

Order: by turn, nulls first; rows of one turn by role and by hash of the text.
Null roles and texts are one space; a row of an empty role can't be kept. Null ids form one conversation of their own.
Conversations without rows have no plan. An empty table gives an empty table;
other input columns are ignored. Texts are compared by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import hash_pair, staged

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
LEGAL_PAIRS = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

# States: nothing yet, after the system turn, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEP = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
FINAL = (EMPTY, ASSISTANT)
STATES = tuple(STEP)
SYMBOLS = ("s", "u", "a")
ANY = -1  # the end of a whole conversation: any final state

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
PIECE_ROWS = 256

Weight = tuple[int, int, str]  # cost, rows, audit
Spans = dict[tuple[int, int], Weight]  # (state before, state after) -> lightest weight


def clean_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one space for null roles and texts."""
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damage(turns: DataFrame) -> DataFrame:
    """The seeded damage: crc32 of ``conv_id:turn`` (null: one space) modulo 20
    drops a row (0), empties its text (1), removes its full stops, exclamation and
    question marks (2), repeats it (3) or sets its role to user (4)."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    rows = clean_turns(turns).withColumn("_k", F.crc32(key) % 20).where(F.col("_k") != 0)
    text = F.when(F.col("_k") == 1, F.lit("")).when(F.col("_k") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _order(*last: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("_h1"), F.col("_h2"),
            *[F.col(c) for c in last]]


def mark_faults(turns: DataFrame) -> DataFrame:
    """Every row without its text: ``conv_id, turn, role, _h1, _h2, initial,
    fault``, the fault being the row's first one."""
    h1, h2 = hash_pair(F.col("text"))
    left = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = clean_turns(turns).select(
        "conv_id", "turn", "role", h1.alias("_h1"), h2.alias("_h2"), F.substring("role", 1, 1).alias("initial"),
        (left == "").alias("blank"), (~F.right(left, F.lit(1)).isin(*STOPS)).alias("cut"))
    seen = Window.partitionBy("conv_id", "role", "_h1", "_h2").orderBy(F.col("turn").asc_nulls_first())
    fault = F.when(F.col("blank"), BLANK).when(F.row_number().over(seen) > 1, DUPLICATE) \
        .when(F.col("cut"), TRUNCATED).otherwise(FINE)
    return rows.select("conv_id", "turn", "role", "_h1", "_h2", "initial", fault.alias("fault"))


# ------------------------------------------------------------------ deduction
def edits_of(initial: str, fault: int) -> list[tuple[str, Weight]]:
    """The edits of a row: resulting symbol ('' if deleted) and weight."""
    out = [("", (COST[DELETE], 1, DELETE))]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        out += [(x, (COST[REROLE] + more, 1, REROLE)) for x in ROLES]
        if initial in SYMBOLS:
            out.append((initial, (COST[KEEP] + more, 1, KEEP)))
    return out


def _joined(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def derive(rows: list[tuple[str, int]], ends: dict[int, int], goals: set[tuple[int, int]]) -> Spans:
    """Lightest derivations over ``rows`` of (initial, fault). ``ends`` maps a
    state at the end to its name; the agenda runs until every (state before, end
    name) of ``goals`` is final or nothing is left."""
    n = len(rows)
    agenda: list[tuple[Weight, tuple]] = [((0, 0, ""), ("suffix", n, q, name)) for q, name in ends.items()]
    agenda += [((COST[INSERT], 0, INSERT), ("insert", x)) for x in ROLES]
    for i, (initial, fault) in enumerate(rows):
        agenda += [(w, ("edit", i, x)) for x, w in edits_of(initial, fault)]
    heapq.heapify(agenda)
    edits: list[dict[str, Weight]] = [{} for _ in rows]
    inserts: dict[str, Weight] = {}
    suffixes: list[dict[tuple[int, int], Weight]] = [{} for _ in range(n + 1)]
    missing = set(goals)

    def deduce(head: Weight, x: str, i: int, of: dict[tuple[int, int], Weight], at: int, only: tuple[int, int] | None = None) -> None:
        """Hyperedges that put ``x`` before the final suffixes ``of`` position ``at``."""
        for q in STATES:
            after = q if x == "" else STEP[q].get(x)
            for key in ([only] if only else list(of)):
                if key[0] == after and (q, key[1]) not in suffixes[i]:
                    heapq.heappush(agenda, (_joined(head, of[key]), ("suffix", i, q, key[1])))

    while agenda and missing:
        weight, item = heapq.heappop(agenda)
        if item[0] == "edit":
            _, i, x = item
            if x not in edits[i]:
                edits[i][x] = weight
                deduce(weight, x, i, suffixes[i + 1], i + 1)
        elif item[0] == "insert":
            inserts[item[1]] = weight
            for i in range(n + 1):
                deduce(weight, item[1], i, suffixes[i], i)
        else:
            _, i, q, name = item
            if (q, name) in suffixes[i]:
                continue
            suffixes[i][q, name] = weight
            if i == 0:
                missing.discard((q, name))
            for x, head in inserts.items():
                deduce(head, x, i, suffixes[i], i, (q, name))
            if i > 0:
                for x, head in edits[i - 1].items():
                    deduce(head, x, i - 1, suffixes[i], i, (q, name))
    return {goal: suffixes[0][goal] for goal in goals if goal in suffixes[0]}


def derive_whole(rows: list[tuple[str, int]]) -> Weight:
    """The lightest derivation of a whole conversation."""
    goal = (EMPTY, ANY)
    return derive(rows, {q: ANY for q in FINAL}, {goal})[goal]


def derive_part(rows: list[tuple[str, int]]) -> Spans:
    """The lightest derivations between all pairs of states."""
    return derive(rows, {q: q for q in STATES}, {(q, r) for q in STATES for r in STATES})


def join_spans(a: Spans, b: Spans) -> Spans:
    """Derivations of two adjacent parts, joined by their state between."""
    out: Spans = {}
    for (q, m), left in a.items():
        for (k, r), right in b.items():
            if m == k:
                both = _joined(left, right)
                if (q, r) not in out or both < out[q, r]:
                    out[q, r] = both
    return out


class _Part:
    """The rows of one conversation in one partition, in order: counts and,
    piece by piece, derivations. Pieces are joined like a binary counter, so an
    audit is copied a logarithmic number of times."""

    def __init__(self, conv: object, first: bool) -> None:
        self.conv, self.first = conv, first  # first: the partition begins with it
        self.rows: list[tuple[str, int]] = []
        self.ladder: list[tuple[int, Spans]] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.head = self.tail = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.tail is None:
            self.head = initial
        elif self.tail + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.tail = initial
        self.faults[fault] += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.rows.append((initial, fault))
        if len(self.rows) == PIECE_ROWS + 1:
            self._piece(self.rows[:PIECE_ROWS])
            self.rows = self.rows[PIECE_ROWS:]

    def _piece(self, rows: list[tuple[str, int]]) -> None:
        level, spans = 0, derive_part(rows)
        while self.ladder and self.ladder[-1][0] == level:
            spans = join_spans(self.ladder.pop()[1], spans)
            level += 1
        self.ladder.append((level, spans))

    def finish(self, last: bool) -> dict:
        """The part as a row. A conversation inside the partition needs only the
        derivation from the first state to a final one."""
        whole = not self.first and not last
        if whole and not self.ladder:
            spans = {(EMPTY, ANY): derive_whole(self.rows)}
        else:
            spans = derive_part(self.rows)
            for _, before in reversed(self.ladder):
                spans = join_spans(before, spans)
        return {"conv_id": self.conv, "rows": sum(self.faults), "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "head": self.head, "tail": self.tail,
                "low": self.low, "high": self.high, "turns": self.turns,
                "spans": [{"q": q, "r": r, "cost": w[0], "audit": w[2]} for (q, r), w in spans.items()]}


_PART_TYPE = "rows long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, " \
    "turns long, spans array<struct<q int, r int, cost long, audit string>>"


def _parts(id_type: str) -> tuple:
    schema = f"conv_id {id_type}, part int, {_PART_TYPE}"
    out = pa.schema([(n, pa.int64()) for n in ("rows", "blank", "duplicate", "truncated", "illegal")] +
                    [("head", pa.string()), ("tail", pa.string())] + [(n, pa.int64()) for n in ("low", "high", "turns")] +
                    [("spans", pa.list_(pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        part, done, kind = None, [], None

        def flush() -> pa.RecordBatch:
            whole = pa.schema([("conv_id", kind), ("part", pa.int32()), *out])
            return pa.RecordBatch.from_pylist([{**d, "part": pid} for d in done], schema=whole)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")]
            for conv, turn, initial, fault in zip(*cols):
                if part is None or conv != part.conv:
                    if part is not None:
                        done.append(part.finish(last=False))
                    part = _Part(conv, first=part is None)
                part.add(turn, initial, fault)
            if len(done) >= 1000:
                yield flush()
                done = []
        if part is not None:
            done.append(part.finish(last=True))
            yield flush()
    return run, schema


class _Plan:
    """Parts of one conversation joined in order, from its first state."""

    def __init__(self, row: dict) -> None:
        self.row = dict(row)
        self.best: Spans = {(s["q"], s["r"]): (s["cost"], 0, s["audit"]) for s in row["spans"] if s["q"] == EMPTY}

    def join(self, row: dict) -> None:
        a = self.row
        a["illegal"] += row["illegal"] + (a["tail"] + row["head"] not in LEGAL_PAIRS)
        a["turns"] += row["turns"] - (row["low"] is not None and a["high"] == row["low"])
        a["low"] = row["low"] if a["low"] is None else a["low"]
        a["high"] = a["high"] if row["high"] is None else row["high"]
        a["tail"] = row["tail"]
        for c in ("rows", "blank", "duplicate", "truncated"):
            a[c] += row[c]
        self.best = join_spans(self.best, {(s["q"], s["r"]): (s["cost"], 0, s["audit"]) for s in row["spans"]})

    def finish(self) -> dict:
        a = self.row
        cost, _, audit = min(w for (_, r), w in self.best.items() if r == ANY or r in FINAL)
        gaps = 0 if a["low"] is None else a["high"] - a["low"] + 1 - a["turns"]
        return {"conv_id": a["conv_id"], "gaps": gaps, "cost": cost, "audit": audit,
                **{c: a[c] for c in ("blank", "duplicate", "truncated", "illegal")}}


PLAN_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def plan_repairs(turns: DataFrame) -> DataFrame:
    """``conv_id``, the counts ``gaps, blank, duplicate, truncated, illegal``, and the
    cheapest repair's ``cost`` and ``audit``, for every conversation of ``turns``
    (``conv_id, turn, role, text``)."""
    marked = staged(mark_faults(turns), "turn-faults")
    id_type = marked.schema["conv_id"].dataType.simpleString()
    run, schema = _parts(id_type)
    parts = staged(marked.repartitionByRange(*_order("fault")).sortWithinPartitions(*_order("fault")).mapInArrow(run, schema), "repair-parts")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if plan is not None and plan.row["conv_id"] == row["conv_id"]:
                    plan.join(row)
                    continue
                if plan is not None:
                    done.append(plan.finish())
                plan = _Plan(row)
            yield emit(done, batch)
            kind = batch
        if plan is not None:
            yield emit([plan.finish()], kind)

    def emit(done: list[dict], like: pa.RecordBatch) -> pa.RecordBatch:
        schema = pa.schema([("conv_id", like.schema.field("conv_id").type), *[(c, pa.int64()) for c in PLAN_COLUMNS], ("audit", pa.string())])
        return pa.RecordBatch.from_pylist(done, schema=schema)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part") \
        .mapInArrow(join, f"conv_id {id_type}, {', '.join(c + ' long' for c in PLAN_COLUMNS)}, audit string")


# ----------------------------------------------------------------- repairing
def apply_repairs(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, position, role, text`` (positions from 0). A
    conversation's rows come one after the other, in order, in one partition."""
    h1, h2 = hash_pair(F.col("text"))
    rows = clean_turns(turns).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text",
                                     h1.alias("_h1"), h2.alias("_h2"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("_h1", "long"), ("_h2", "long"))]
    both = rows.unionByName(plans.select("conv_id", "audit", *none)).repartition("conv_id") \
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), *_order()[1:])
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, rows_end, state, position, conv = "", 0, 0, EMPTY, 0, None
        for batch in batches:
            out: list[tuple] = []

            def inserts() -> None:
                nonlocal at, state, position
                while at < len(audit) and audit[at] == INSERT:
                    x = "a" if state == USER else "u"
                    out.append((conv, position, ROLES[x], ""))
                    state, position, at = STEP[state][x], position + 1, at + 1

            cols = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]
            for cid, plan, role, text in zip(*cols):
                if plan is not None:
                    audit, at, state, position, conv = plan, 0, EMPTY, 0, cid
                    rows_end = len(plan.rstrip(INSERT))
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit != DELETE:
                    x = role[:1] if edit == KEEP else "a" if state == USER else "u"
                    out.append((conv, position, role if edit == KEEP else ROLES[x], text))
                    state, position = STEP[state][x], position + 1
                if at == rows_end:
                    inserts()  # after the last row
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["conv_id", "position", "role", "text"])

    return both.mapInArrow(run, f"conv_id {id_type}, position long, role string, text string")


def digest_turns(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha256`` over the newline-joined ``role:text`` of the result of
    ``apply_repairs``, streamed in its order."""
    id_type = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, conv, kind = None, None, None
        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for cid, position, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if position == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    digest, conv = hashlib.sha256(), cid
                digest.update((("\n" if position else "") + role + ":" + text).encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())],
                                             names=["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "sha256"])

    return repaired.mapInArrow(run, f"conv_id {id_type}, sha256 string")
