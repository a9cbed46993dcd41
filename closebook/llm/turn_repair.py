"""Conversation structure repair by secondary-sorted streaming.

Conversations are repartitioned by id and sorted by turn; one pass carries the
state of a dynamic programme over the rows, across Arrow batches. Its states
are what the repaired conversation ends with (nothing, system, user,
assistant); for each it keeps the cheapest edits so far, the least audit among
those (as the order of the four audits; between rows none is a prefix of
another), and the hash of the repaired text. Each row leaves four bytes of
backpointers, from which the audit is read at the end.

A conversation of more than ``held_rows`` rows spills: its backpointers leave
the task as rows of the output, a chunk at a time, and a second pass reads the
chunks of such conversations backwards, one at a time. So no task holds more
than a chunk of rows of any conversation. The pass over one conversation is
one task's stream, because its digest has to be read in order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from closebook.llm.common import SPACES, settle

HELD_ROWS = 1 << 16
#: Costs of the edits, and of keeping a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
INF = 1 << 62

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to, by the state before it.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The states in which a row with this initial may be kept, and what follows.
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
         "a": {USER: ASSISTANT}}
TOKENS = [i + op for op in "DKR" for i in ("", "I", "II")]
#: What closes the conversation: (cost, inserts) by state.
ENDS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
FAULTS = ("blank", "duplicate", "truncated")
COUNTS = ("gaps", *FAULTS, "illegal", "cost")


def _moves(initial: str, gone: bool, cut: bool) -> list[list[tuple[int, int, int]]]:
    """By state: the (next state, cost, token number) of a row, the cheapest
    for each next state, and the least token among those."""
    table = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, paid = state, 0
        for inserts in ("", "I", "II"):
            options = [(at, DELETE, "D")]
            if not gone:
                extra = TRUNCATED if cut else 0
                options.append((NEXT[at], REROLE + extra, "R"))
                if at in KEEPS.get(initial, {}):
                    options.append((KEEPS[initial][at], extra, "K"))
            for to, cost, op in options:
                best[to] = min(best.get(to, (INF, "")), (paid + cost, inserts + op))
            at, paid = NEXT[at], paid + INSERT
        table.append([(to, cost, TOKENS.index(token)) for to, (cost, token) in best.items()])
    return table


MOVES = {(i, gone, cut): _moves(i, gone, cut)
         for i in ("s", "u", "a", "") for gone in (True, False) for cut in (True, False)}


class Stream:
    """The rows of one conversation, one after the other."""

    def __init__(self, held_rows: int):
        self.held = 4 * held_rows

    def open(self, conv_id) -> None:
        self.conv_id, self.chunk, self.back = conv_id, 0, bytearray()
        self.cost, self.rank, self.sha = [0, INF, INF, INF], [0, 0, 0, 0], [hashlib.sha256()] * 4
        self.faults = [0, 0, 0, 0]
        self.illegal, self.initial = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, role: str, text: str, initial: str, fault: int):
        """Returns a chunk of backpointers when it is full."""
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        moves = MOVES[initial if initial in KEEPS else "", fault in (BLANK, DUPLICATE),
                      fault == CUT]
        best: list = [None] * 4
        for state in range(4):
            paid, rank = self.cost[state], self.rank[state]
            if paid >= INF:
                continue
            for to, cost, token in moves[state]:
                new = (paid + cost, rank, TOKENS[token], state, token)
                if best[to] is None or new < best[to]:
                    best[to] = new
        shas, line = [None] * 4, None
        for to, new in enumerate(best):
            if new is None:
                self.back.append(255)
                continue
            _, _, edits, state, token = new
            self.back.append(4 * token + state)
            sha = self.sha[state]
            if edits != "D":
                sha = sha.copy()
                at = state
                for edit in edits:
                    if edit == "D":
                        break
                    if edit == "K":
                        line = line or f"{role}:{text}".encode()
                        added = line
                    else:
                        added = f"{ROLE[NEXT[at]]}:{text if edit == 'R' else ''}".encode()
                    sha.update(b"\n" + added if at != START else added)
                    at = NEXT[at]
            shas[to] = sha
        alive = sorted((b[1], b[2], to) for to, b in enumerate(best) if b is not None)
        self.cost = [INF if b is None else b[0] for b in best]
        self.sha = shas
        for place, (_, _, to) in enumerate(alive):
            self.rank[to] = place
        if len(self.back) >= self.held:
            return self.spill()
        return None

    def spill(self) -> dict:
        out = {"conv_id": self.conv_id, "chunk": self.chunk, "back": bytes(self.back)}
        self.chunk, self.back = self.chunk + 1, bytearray()
        return out

    def close(self) -> list[dict]:
        cost, _, end = min((self.cost[s] + ENDS[s][0], self.rank[s], s) for s in range(4)
                           if self.cost[s] < INF)
        sha, tail = self.sha[end].copy(), ENDS[end][1]
        at = end
        for _ in tail:
            sha.update(("" if at == START else "\n").encode() + f"{ROLE[NEXT[at]]}:".encode())
            at = NEXT[at]
        out = [self.spill()] if self.chunk and self.back else []
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        audit = None if self.chunk else trace(self.back, end)[0] + tail
        values = dict(zip(COUNTS, (gaps, *self.faults[1:], self.illegal, cost)))
        return [*out, {"conv_id": self.conv_id, "chunk": self.chunk, "end": end, "tail": tail,
                       "audit": audit, "repaired_sha256": sha.hexdigest(), **values}]


def trace(back: bytes, state: int) -> tuple[str, int]:
    """The edits that led to ``state`` over these backpointers, and the state
    before them."""
    edits = []
    for at in range(len(back) - 4, -1, -4):
        token, state = divmod(back[at + state], 4)
        edits.append(TOKENS[token])
    return "".join(reversed(edits)), state


def _streamed(held_rows: int, schema: T.StructType):
    names = schema.names
    arrow = None

    def run(batches):
        nonlocal arrow
        stream, opened, out = Stream(held_rows), False, []
        for batch in batches:
            if arrow is None:
                arrow = _arrow(batch.schema.field("conv_id").type)
            for conv_id, turn, role, text, initial, fault, present in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if not opened or conv_id != stream.conv_id:
                    out += stream.close() if opened else []
                    stream.open(conv_id)
                    opened = True
                if present and (full := stream.add(turn, role, text, initial, fault)):
                    yield _rows([*out, full], names, arrow)
                    out = []
            yield _rows(out, names, arrow)
            out = []
        if opened:
            yield _rows(stream.close(), names, arrow)

    return run


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", id_type), ("chunk", pa.int32()), ("back", pa.binary()),
                      ("end", pa.int32()), ("tail", pa.string()), ("audit", pa.string()),
                      ("repaired_sha256", pa.string()), *[(c, pa.int64()) for c in COUNTS]])


def _rows(rows: list[dict], names: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(c) for r in rows], arrow.field(c).type) for c in names], schema=arrow)


def _backwards(batches):
    """Edits of each chunk of giant conversations, whose rows come last first."""
    conv_id, state = None, None
    for batch in batches:
        pieces = []
        for c, back, end, tail in zip(*(batch.column(n).to_pylist()
                                        for n in ("conv_id", "back", "end", "tail"))):
            if end is not None:
                conv_id, state = c, end
                pieces.append(tail)
            else:
                edits, state = trace(back, state)
                pieces.append(edits)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"),
                                          pa.array(pieces, pa.string())],
                                         ["conv_id", "chunk", "piece"])


def faulty_rows(turns: DataFrame, is_turn: Column) -> DataFrame:
    """(conv_id, turn, role, text, initial, fault, present, seen), partitioned by
    conversation and sorted by turn. Repeats are numbered within the same
    partitions, by a second sort, not a second shuffle."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), F.coalesce(is_turn, F.lit(False)).alias("present"))
    rows = rows.select("*", F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(1), "role", "text").alias("b")).repartition("conv_id")
    again = Window.partitionBy("conv_id", "present", "a", "b").orderBy("turn")
    last = F.right(F.btrim("text", F.lit(SPACES)), F.lit(1))
    fault = (F.when(last == "", BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~last.isin(".", "!", "?"), CUT).otherwise(NO_FAULT))
    return (rows.withColumn("seen", F.row_number().over(again))
            .sortWithinPartitions("conv_id", "turn", "role", "text", "seen")
            .select("conv_id", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"),
                    fault.cast("int").alias("fault"), "present"))


def repair_conversations(turns: DataFrame, is_turn: Column | None = None,
                         held_rows: int = HELD_ROWS) -> DataFrame:
    """One row a conversation of ``turns`` (conv_id, turn, role, text): its
    faults, and the cheapest edits to ``(s?(ua)+)?`` by initials of the roles.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (K keep, R
    rerole, D delete, I insert, the ASCII-least of the cheapest),
    repaired_sha256 (of ``role:text`` lines). Rows where ``is_turn`` is not
    true only name their conversation.

    Defined cases: a null role or text is one space; a null turn comes first;
    equal turns are ordered by role, then text; rows repeated as a whole are
    duplicates; null conversation ids are one conversation; without rows all
    counts are 0, the audit is empty and the hash that of the empty string; a
    role of other initials, or an empty one, must be reroled or deleted; texts
    of any length pass one row at a time; an empty table gives no rows; other
    columns are not read.
    """
    rows = faulty_rows(turns, F.lit(True) if is_turn is None else is_turn)
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(
        "chunk int, back binary, `end` int, tail string, audit string, repaired_sha256 string, "
        + ", ".join(f"{c} long" for c in COUNTS))])
    out = settle(rows.mapInArrow(_streamed(held_rows, schema), schema), "repairs")
    columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    whole = out.where(F.col("audit").isNotNull()).select(columns)
    spilled = out.where(F.col("audit").isNull())
    pieces = (spilled.repartition("conv_id")
              .sortWithinPartitions("conv_id", F.desc("chunk"), F.desc_nulls_last("end"))
              .mapInArrow(_backwards, T.StructType([schema["conv_id"], *T.StructType.fromDDL(
                  "chunk int, piece string")])))
    audits = pieces.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("chunk", "piece"))), lambda p: p["piece"]), "").alias("audit"))
    giants = spilled.where(F.col("end").isNotNull()).drop("audit").alias("g").join(
        audits.alias("a"), F.col("g.conv_id").eqNullSafe(F.col("a.conv_id"))).select(
        "g.conv_id", *COUNTS, "a.audit", "repaired_sha256")
    return whole.union(giants)


def repaired_turns(turns: DataFrame, repairs: DataFrame,
                   is_turn: Column | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations, the
    edits of ``repair_conversations`` applied in one more pass. An audit is a
    string of one row, so the pass holds it, and one row at a time."""
    rows = faulty_rows(turns, F.lit(True) if is_turn is None else is_turn)
    rows = rows.where("present").select("conv_id", F.lit(1).alias("part"), "turn", "role", "text",
                                        "fault", F.lit("").alias("audit"))
    edits = repairs.where("audit <> ''").select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("fault"), "audit")
    # A repeated row's first copy comes first here as well: it has no fault or CUT.
    order = F.when(F.col("fault") == DUPLICATE, 1).otherwise(0)
    both = rows.union(edits).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "turn", "role", "text", order)

    def apply(batches):
        audit, at, state, position = "", 0, START, 0
        for batch in batches:
            ids, out = batch.column("conv_id"), []
            for n, (part, role, text, edits) in enumerate(zip(*(
                    batch.column(c).to_pylist() for c in ("part", "role", "text", "audit")))):
                if part == 0:
                    audit, at, state, position = edits, 0, START, 0
                    continue
                while True:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        new = KEEPS[role[:1]][state] if edit == "K" else NEXT[state]
                        position += 1
                        out.append((n, position, edit, role if edit == "K" else ROLE[new],
                                    "" if edit == "I" else text))
                        state = new
                    if edit != "I":
                        break
                # Inserts that close the conversation.
                while 0 < len(audit) - at <= 2 and set(audit[at:]) == {"I"}:
                    state, position, at = NEXT[state], position + 1, at + 1
                    out.append((n, position, "I", ROLE[state], ""))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([r[0] for r in out], pa.int64())),
                 pa.array([r[1] for r in out], pa.int64()),
                 *[pa.array([r[i] for r in out], pa.string()) for i in (2, 3, 4)]],
                ["conv_id", "position", "edit", "role", "text"])

    return both.mapInArrow(apply, T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(
        "position long, edit string, role string, text string")]))
