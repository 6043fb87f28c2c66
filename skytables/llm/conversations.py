"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``.

Spark does the row work: damage (``crc32`` of ``conv_id:turn``), faults (blank, duplicate, truncated) and the order of
rows. Duplicates are found by the least position of each (conversation, role, text), a partial aggregate and a join,
so that no window holds a hot conversation. Only the edit search is sequential: rows of a conversation arrive sorted in
one task and a Viterbi pass over the four states of the role grammar streams through them.

Survivor coalescence keeps its memory bounded: the survivors of the four states hang in a tree of backpointers with
reference counts; as soon as all of them descend from one child of the root, that child's edit is final, it is emitted
(audit letter and repaired line, hashed as they come) and its node becomes the root. Survivors that can no longer win
(their cost exceeds another's by more than it can ever make up, ``_CATCH_UP``) are released, so the tree stays shallow.
Ties of cost are broken by the whole unresolved suffix of the audit, compared letter by letter; the emitted prefix is
common to all survivors, so this yields the ASCII-least audit of all cheapest repairs.

Edge cases: NULL text or role is one space (so NULL text is blank); NULL turns sort first and are left out of
``gaps``; a NULL conv_id is a conversation of its own; a conversation whose rows are all dropped gets zeros, an empty
audit and the hash of the empty string; repeated rows are separate rows (the second is a duplicate); an empty table
gives no rows; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
# Fixed values of the contract: edit costs and the role grammar.
COST_KEEP, COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 0, 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
SPACE_CLASS = r"[\x20\x09-\x0D]"

# States of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a. 0 and 3 accept.
_ACCEPT = (0, 3)
# _CATCH_UP[p][q] bounds future(p) - future(q): from p one can follow q's best continuation at this extra cost at
# most. A survivor of q costing more than p's survivor plus this can never be part of a cheapest repair.
_BASE = {(3, 1): 0, (1, 3): 6, (3, 0): 4, (0, 3): 0, (3, 2): 3, (2, 3): 3}


def _catch_up() -> list[list[float]]:
    inf = float("inf")
    d = [[0 if p == q else _BASE.get((p, q), inf) for q in range(4)] for p in range(4)]
    for k in range(4):
        for p in range(4):
            for q in range(4):
                d[p][q] = min(d[p][q], d[p][k] + d[k][q])
    return d


_CATCH_UP = _catch_up()

RESULT = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("gaps", T.LongType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
_ARROW = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in RESULT.fields])
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after damage, with their fault and their place: conv_id, turn, role, text, fault, pos_* sort columns.

    ``crc32('conv_id:turn') % 20``: 0 drops the row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats it right after
    itself, 4 makes it a user row. NULLs are one space, in the key as in role and text.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.monotonically_increasing_id().alias("pos_uid"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(F.encode(key, "UTF-8")) % 20
    damaged = (
        rows.withColumn("_hit", hit)
        .where(F.col("_hit") != 0)
        .withColumn("text", F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("_hit") == 4, F.lit(USER)).otherwise(F.col("role")))
        .withColumn("pos_copy", F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("_hit")
    )
    order = F.struct(F.col("turn").isNotNull(), "turn", "role", "text", "pos_uid", "pos_copy")
    damaged = damaged.withColumn("_pos", order)
    # the first place of each (conversation, role, text): partial aggregate, then a join AQE may split when skewed
    first = damaged.groupBy("conv_id", "role", "text").agg(F.min("_pos").alias("_first"))
    first = first.select(F.col("conv_id").alias("_f_conv"), F.col("role").alias("_f_role"), F.col("text").alias("_f_text"), "_first")
    match = F.col("conv_id").eqNullSafe(F.col("_f_conv")) & (F.col("role") == F.col("_f_role")) & (F.col("text") == F.col("_f_text"))
    damaged = damaged.join(first, match).drop("_f_conv", "_f_role", "_f_text")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(blank, F.lit(BLANK))
        .when(F.col("_pos") > F.col("_first"), F.lit(DUPLICATE))
        .when(~last.isin(".", "!", "?"), F.lit(TRUNCATED))
        .otherwise(F.lit(0))
    )
    return damaged.select("conv_id", "turn", "role", "text", fault.alias("fault"), "pos_uid", "pos_copy")


class _Node:
    __slots__ = ("letter", "line", "parent", "kids", "held")

    def __init__(self, letter, line, parent):
        self.letter, self.line, self.parent, self.kids, self.held = letter, line, parent, 0, 0
        if parent is not None:
            parent.kids += 1


def _release(node: _Node) -> None:
    node.held -= 1
    while node is not None and node.held == 0 and node.kids == 0:
        parent = node.parent
        node.parent = None
        if parent is not None:
            parent.kids -= 1
        node = parent


def _hopeless(cost: int, q: int, chosen: list) -> bool:
    """Whether a survivor of state q at this cost can never be part of a cheapest repair, given the other states."""
    return any(c is not None and p != q and cost > c[0] + _CATCH_UP[p][q] for p, c in enumerate(chosen))


def _letters(node: _Node, root: _Node) -> list[str]:
    out = []
    while node is not root:
        out.append(node.letter)
        node = node.parent
    out.reverse()
    return out


class Repair:
    """Streaming Viterbi over one conversation's rows; ``add`` a row at a time, then ``finish``."""

    def __init__(self):
        self.root = _Node("", None, None)
        self.root.held = 2  # its hold as root and the survivor of state 0
        self.survivors: list[tuple[int, _Node] | None] = [(0, self.root), None, None, None]
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.lines = 0
        self._close()

    # candidate: (cost, parent node, letter, line); the better of two has the lower cost, then the least audit
    def _path(self, cand) -> list[str]:
        path = _letters(cand[1], self.root)
        if cand[2]:
            path.append(cand[2])
        return path

    def _better(self, a, b) -> bool:
        if b is None:
            return True
        if a[0] != b[0]:
            return a[0] < b[0]
        if a[1] is b[1]:
            return (a[2] or "") < (b[2] or "")
        return self._path(a) < self._path(b)

    def _settle(self, chosen: list) -> None:
        """Make the chosen candidates the survivors, prune the hopeless, release the old, emit what is decided."""
        new: list[tuple[int, _Node] | None] = [None] * 4
        for q, cand in enumerate(chosen):
            if cand is None:
                continue
            cost, parent, letter, line = cand
            node = parent if letter is None else _Node(letter, line, parent)
            node.held += 1
            new[q] = (cost, node)
        costs = [s[0] if s else None for s in new]
        for q in range(4):
            if new[q] is not None and any(costs[p] is not None and costs[q] > costs[p] + _CATCH_UP[p][q] for p in range(4) if p != q):
                _release(new[q][1])
                new[q] = None
        for old in self.survivors:
            if old is not None:
                _release(old[1])
        self.survivors = new
        self._emit()

    def _emit(self) -> None:
        root = self.root
        while root.held == 1 and root.kids == 1 and not any(s is not None and s[1] is root for s in self.survivors):
            child = next(s[1] for s in self.survivors if s is not None)
            while child.parent is not root:
                child = child.parent
            self._write(child)
            child.parent = None
            root.kids = 0
            child.held += 1  # the root's hold
            root = child
        self.root = root

    def _write(self, node: _Node) -> None:
        self.audit.append(node.letter)
        if node.line is not None:
            self.hash.update((("\n" if self.lines else "") + node.line).encode("utf-8"))
            self.lines += 1

    def _close(self) -> None:
        """Insertions between rows: u from 0, 1 or 3; a from 2. Repeated until nothing improves."""
        chosen = [(s[0], s[1], None, None) if s else None for s in self.survivors]
        changed = True
        while changed:
            changed = False
            for q in range(4):
                if chosen[q] is None:
                    continue
                cost = chosen[q][0] + COST_INSERT
                if q == 2:
                    target, role = 3, ASSISTANT
                else:
                    target, role = 2, USER
                parent = chosen[q][1] if chosen[q][2] is None else None
                if parent is None:
                    continue  # an inserted step is turned into a node below before it is extended
                cand = (cost, parent, "I", role + ":")
                if not _hopeless(cost, target, chosen) and self._better(cand, chosen[target]):
                    chosen[target] = cand
                    changed = True
            # extending an insertion needs its node: make nodes for the new insertions and loop again
            if changed:
                self._settle(chosen)
                chosen = [(s[0], s[1], None, None) if s else None for s in self.survivors]
        self._settle(chosen)

    def add(self, role: str, text: str, fault: int) -> None:
        chosen: list = [None] * 4
        extra = COST_TRUNCATED if fault == TRUNCATED else 0
        initial = role[:1]
        for q, surv in enumerate(self.survivors):
            if surv is None:
                continue
            cost, node = surv
            cands = [(q, (cost + COST_DELETE, node, "D", None))]
            if fault not in (BLANK, DUPLICATE):
                if q == 0 and initial == "s":
                    cands.append((1, (cost + COST_KEEP + extra, node, "K", f"{role}:{text}")))
                if q != 2 and initial == "u":
                    cands.append((2, (cost + COST_KEEP + extra, node, "K", f"{role}:{text}")))
                if q == 2 and initial == "a":
                    cands.append((3, (cost + COST_KEEP + extra, node, "K", f"{role}:{text}")))
                target, new_role = (3, ASSISTANT) if q == 2 else (2, USER)
                cands.append((target, (cost + COST_REROLE + extra, node, "R", f"{new_role}:{text}")))
            for target, cand in cands:
                if self._better(cand, chosen[target]):
                    chosen[target] = cand
        self._settle(chosen)
        self._close()

    def finish(self) -> tuple[int, str, str]:
        best = None
        for q in _ACCEPT:
            s = self.survivors[q]
            if s is not None and self._better((s[0], s[1], "", None), best):
                best = (s[0], s[1], "", None)
        cost, node = best[0], best[1]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._write(node)
        return cost, "".join(self.audit), self.hash.hexdigest()


def _sequential(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place; one result per conversation, memory bounded by the unresolved tree."""
    names = [f.name for f in RESULT.fields]
    out: dict[str, list] = {n: [] for n in names}
    state = None

    def flush():
        cost, audit, digest = state["repair"].finish()
        t = state["turns"]
        out["conv_id"].append(state["conv"])
        out["gaps"].append(t[1] - t[0] + 1 - t[2] if t else 0)
        for key in ("blank", "duplicate", "truncated", "illegal", "n_rows"):
            out[key].append(state[key])
        out["cost"].append(cost)
        out["audit"].append(audit)
        out["repaired_sha256"].append(digest)

    for batch in batches:
        cols = batch.to_pydict()
        for conv, turn, role, text, fault in zip(cols["conv_id"], cols["turn"], cols["role"], cols["text"], cols["fault"]):
            if state is None or state["conv"] != conv:
                if state is not None:
                    flush()
                state = {"conv": conv, "repair": Repair(), "turns": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "n_rows": 0, "last": None}
            state["n_rows"] += 1
            state["blank"] += fault == BLANK
            state["duplicate"] += fault == DUPLICATE
            state["truncated"] += fault == TRUNCATED
            initial = role[:1]
            if state["last"] is not None and state["last"] + initial not in ("su", "ua", "au"):
                state["illegal"] += 1
            state["last"] = initial
            if turn is not None:
                t = state["turns"]
                state["turns"] = [turn, turn, 1] if t is None else [t[0], turn, t[2] + (turn != t[1])]
            state["repair"].add(role, text, fault)
        if len(out["conv_id"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW)
            out = {n: [] for n in names}
    if state is not None:
        flush()
    if out["conv_id"]:
        yield pa.RecordBatch.from_pydict(out, schema=_ARROW)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, n_rows (rows after damage)."""
    rows = damage(conversations)
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "pos_uid", "pos_copy"
    )
    repaired = ordered.select("conv_id", "turn", "role", "text", "fault").mapInArrow(_sequential, RESULT)
    every = conversations.select(F.col("conv_id").cast("long").alias("_every")).groupBy("_every").agg(F.lit(1).alias("_any"))
    zero = F.lit(0).cast("long")
    joined = every.join(repaired, every["_every"].eqNullSafe(repaired["conv_id"]), "left")
    return joined.select(
        F.col("_every").alias("conv_id"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("repaired_sha256"), F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
        F.coalesce(F.col("n_rows"), zero).alias("n_rows"),
    )
