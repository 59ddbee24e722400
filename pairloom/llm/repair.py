"""Conversation repair: the cheapest edits that make a damaged conversation well formed, kept as an audit."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Costs of the edits, and what an undeleted truncated turn adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system, a user, an assistant turn. A conversation may end in the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a turn of this initial leads to, and what a turn made or inserted in a state must be.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
_MOD, _BASE = (1 << 61) - 1, 1_000_003
#: Nodes after which those that all live audits share are written out.
FLUSH = 8192

AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Audits:
    """Strings of edits that share their prefixes: a node is a string, its parent the string without the last edit.

    A node knows its length, its ancestors 1, 2, 4, ... edits up and a rolling hash of the whole string, so that two
    strings are compared in the logarithm of their length: both climb together as far as hashes differ, which ends at
    the first edit that differs. Equal hashes of different nodes are checked edit by edit before they count as equal."""

    def __init__(self) -> None:
        self.edit, self.size, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, edit: str) -> int:
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.edit.append(edit)
        self.size.append(self.size[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _MOD)
        self.up.append(up)
        return len(self.edit) - 1

    def cut(self, node: int, size: int) -> int:
        """The ancestor of this size."""
        while self.size[node] > size:
            up = self.up[node]
            node = up[min(len(up), (self.size[node] - size).bit_length()) - 1]
        return node

    def equal(self, a: int, b: int) -> bool:
        if self.hash[a] != self.hash[b] or self.size[a] != self.size[b]:
            return False
        while a != b:  # shared nodes are the same string; above them each edit is looked at
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """a comes before b in ASCII order."""
        size = min(self.size[a], self.size[b])
        x, y = self.cut(a, size), self.cut(b, size)
        if self.equal(x, y):
            return self.size[a] < self.size[b]
        for k in range(len(self.up[x]) - 1, -1, -1):  # the longest common prefix ends right above x and y
            if k < len(self.up[x]) and not self.equal(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.edit[x] < self.edit[y]

    def text(self, node: int, above: int = 0) -> str:
        """The edits of node that come after those of above."""
        found = []
        while node != above:
            found.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(found))

    def shared(self, nodes: list[int]) -> int:
        """The longest string that all nodes start with as a node."""
        size = min(self.size[n] for n in nodes)
        nodes = [self.cut(n, size) for n in nodes]
        for k in range(len(self.up[nodes[0]]) - 1, -1, -1):
            if k < len(self.up[nodes[0]]) and len({self.up[n][k] for n in nodes}) > 1:
                nodes = [self.up[n][k] for n in nodes]
        return nodes[0] if len(set(nodes)) == 1 else self.up[nodes[0]][0]


class Repair:
    """The cheapest audits of one conversation, turn by turn: the best for each state that it can be in."""

    def __init__(self) -> None:
        self.audits, self.best, self.done, self.most = Audits(), {START: (0, 0)}, [], FLUSH

    def _offer(self, into: dict, state: int, cost: int, parent: int, edit: str) -> None:
        old = into.get(state)
        if old is None or cost <= old[0]:
            node = self.audits.add(parent, edit)
            if old is None or cost < old[0] or self.audits.less(node, old[1]):
                into[state] = (cost, node)

    def _insert(self) -> None:
        for state in (START, SYSTEM, USER, ASSISTANT, USER):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(self.best, NEXT[state], cost + INSERT, node, "I")

    def turn(self, initial: str, faulty: bool, truncated: bool) -> None:
        """faulty: blank or a duplicate, so it must go."""
        self._insert()
        after: dict[int, tuple[int, int]] = {}
        more = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(after, state, cost + DELETE, node, "D")
            if not faulty:
                if (state, initial) in KEPT:
                    self._offer(after, KEPT[state, initial], cost + more, node, "K")
                self._offer(after, NEXT[state], cost + REROLE + more, node, "R")
        self.best = after
        if len(self.audits.edit) > self.most:
            self._flush()

    def _flush(self) -> None:
        old, at = self.audits, self.audits.shared([n for _, n in self.best.values()])
        self.done.append(old.text(at))
        self.audits, moved = Audits(), {}
        for state, (cost, node) in self.best.items():
            fresh = 0
            for e in old.text(node, at):
                if (fresh, e) not in moved:
                    moved[fresh, e] = self.audits.add(fresh, e)
                fresh = moved[fresh, e]
            self.best[state] = (cost, fresh)
        self.most = max(FLUSH, 2 * len(self.audits.edit))

    def result(self) -> tuple[int, str]:
        self._insert()
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or (c == cost and self.audits.less(n, node)):
                cost, node = c, n
        return cost, "".join(self.done) + self.audits.text(node)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and order -> a row for each conversation."""
    key, state, out = object(), None, []

    def close() -> None:
        if state is not None:
            cost, audit = state["repair"].result()
            gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
            out.append((key, gaps, *state["faults"], state["illegal"], cost, audit))

    def flushed() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
        out.clear()
        return made

    for b in batches:
        for conv, turn, dropped, initial, fault in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "dropped", "initial", "fault")), strict=True):
            if state is None or conv != key:
                close()
                key = conv
                state = {"repair": Repair(), "low": 0, "high": 0, "turns": 0, "faults": [0, 0, 0], "illegal": 0, "last": None}
            if dropped:
                continue
            if turn is not None and (not state["turns"] or turn != state["high"]):
                state["low"] = state["low"] if state["turns"] else turn
                state["high"], state["turns"] = turn, state["turns"] + 1
            if fault:
                state["faults"][fault - 1] += 1
            if state["last"] is not None and state["last"] + initial not in ("su", "ua", "au"):
                state["illegal"] += 1
            state["last"] = initial
            state["repair"].turn(initial, fault in (1, 2), fault == 3)
        if len(out) > 1000:
            yield flushed()
    close()
    yield flushed()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation a row with its audit, then its turns in order -> that row with the hash of the repaired
    text, which is never held as a whole."""
    head, digest, at, state, first = None, None, 0, START, True
    done: list[tuple[dict, str]] = []

    def write(role: str, text: str) -> None:
        nonlocal first
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "replace"))
        first = False

    def inserted() -> None:
        nonlocal at, state
        while head["audit"][at : at + 1] == "I":
            at, state = at + 1, NEXT[state]
            write(NAMES[state], "")

    def close() -> None:
        if head is not None:
            inserted()
            done.append((head, digest.hexdigest()))

    for b in batches:
        schema = b.schema
        for a, role, text in zip(*(b.column(n).to_pylist() for n in ("head", "role", "text")), strict=True):
            if a is not None:
                close()
                head, digest, at, state, first = a, hashlib.sha256(), 0, START, True
                continue
            inserted()
            edit, at = head["audit"][at], at + 1
            if edit == "K":
                state = KEPT[state, role[:1]]
                write(role, text)
            elif edit == "R":
                state = NEXT[state]
                write(NAMES[state], text)
        if len(done) > 1000:
            yield _heads(done, schema)
            done = []
    close()
    if done:
        yield _heads(done, schema)


def _heads(done: list[tuple[dict, str]], schema: pa.Schema) -> pa.RecordBatch:
    kind = schema.field("head").type
    names = [kind.field(i).name for i in range(kind.num_fields)]
    columns = [pa.array([h[n] for h, _ in done], kind.field(i).type) for i, n in enumerate(names)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([s for _, s in done], pa.string())], [*names, "repaired_sha256"])


def damage(turns: DataFrame) -> DataFrame:
    """conversations -> conv_id, turn, role, text, dropped: rows with trial faults, chosen by the CRC of conv_id:turn; a
    row that is to be lost is marked so, a repeated one comes twice. Nulls are read as a space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), "kind")
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text", "dropped")


def _in_order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped (rows marked so only name their conversation) -> conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256: one row for each conv_id, the null one included.

    A conversation's rows stand in the order of their turns, null first; of one turn in that of role, then of the text's
    MD5. Faults, of which a row has the first that fits: blank (white space only), duplicate (its role and text came
    before), truncated (it doesn't end in one of . ! ?). The audit is the cheapest list of edits that leaves a
    conversation of an optional system turn and pairs of user and assistant turns; of equally cheap ones the first in
    ASCII order. A null role or text is read as a space; a role's initial is its first character. Other columns are
    ignored, an empty table gives an empty one.

    The search keeps the best audit for each state a conversation can be in (Repair); audits share prefixes (Audits).
    It reads an initial and a fault for each turn, no texts; nodes that all live audits share are written out on the
    way, so its memory grows with the edits still open and one letter a turn. The hash of the repaired text has to be
    taken in order, so a conversation is one task's work; that task streams its sorted rows and holds no more than a
    batch of them.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    rows = rows.withColumn("digest", F.md5("text"))
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    narrow = rows.select("conv_id", "turn", "dropped", "role", "digest", end.alias("end"))
    # all of it by conversation: the shuffle serves the search for duplicates and the sorted stream
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("end") == "", 1).when(seen > 1, 2).when(~F.col("end").isin(*ENDS), 3).otherwise(0)
    marked = narrow.repartition("conv_id").select("conv_id", "turn", "dropped", "role", "digest", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))
    found = marked.sortWithinPartitions(*_in_order()).select("conv_id", "turn", "dropped", "initial", "fault").mapInArrow(_audited, f"conv_id long, {AUDIT}")
    head = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("digest"), F.struct(*found.columns).alias("head"))
    texts = rows.where("not dropped").select("conv_id", "turn", "role", "text", "digest", F.lit(None).cast(head.schema["head"].dataType).alias("head"))
    conv, *order = _in_order()
    both = head.unionByName(texts).repartition("conv_id").sortWithinPartitions(conv, F.col("head").isNull(), *order)
    return both.select("head", "role", "text").mapInArrow(_hashed, f"conv_id long, {AUDIT}, repaired_sha256 string")
