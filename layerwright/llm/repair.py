"""Conversation structure repair by a Viterbi search that decides as soon as its survivors agree.

Rows of a conversation, in order of turn, are kept (K), given another role (R), deleted (D) or joined by inserted empty turns (I)
so that the initials of the roles read `(s?(ua)+)?`, at least cost; of equally cheap edits the letters that sort first win. The
search keeps one survivor for each state of that grammar. Survivors are leaves of a tree of back pointers with reference counts:
a branch that no survivor needs goes at once, and as soon as all survivors share an ancestor the edits up to it are final and
leave memory. Survivors of equal cost are compared over their whole undecided suffixes, down to their common ancestor. (At the
same row two equally cheap survivors never are prefixes of each other, as the longer one would have paid for more insertions;
so the smaller one stays smaller whatever follows.) A survivor that can't win any more goes: what may follow the empty state
may follow an assistant turn for 3 more (a system turn is deleted), what may follow a system turn may follow it for the same.

On Spark: one range shuffle deals the rows by conversation and turn, so that a conversation of any size lies over neighbouring
slices. A task reads its slice in order and finishes every conversation that begins and ends inside it. The first and the last
conversation of a slice may go on in its neighbours; their rows go a second way that holds for any size: duplicates by a grouped
minimum of unique row numbers, blocks of BLOCK rows searched from all four entry states at once, and a search along the blocks
that joins them, with whole blocks as edits of the same tree. The digest of the repaired text is serial by its definition: there
the rows of one conversation stream through one task, a batch at a time.

Null roles and texts are one space, and null ids and turns count as one space in the damage key; a null id is a conversation of
its own, a null turn comes first. Rows of the same turn are ordered by role, then by a hash of the text. A role has its first
character as its initial; the empty role has none and can't be kept. White space is 0x20 and 0x09-0x0D. Repeated rows of the
same conversation and turn are duplicates. A conversation without rows gives zeros and an empty audit. An empty table gives no
rows. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import prepared

# rows of a long conversation that are searched at once
BLOCK = 4096
_SPACE, _ENDS = " \t\n\v\f\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# states: nothing yet, after the system turn, after a user turn, after an assistant turn; the first and last may end
START, SYSTEM, USER, ASSISTANT = range(4)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
# state -> {initial: next state}
_NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_SPLICE = tuple(next(s for i, s in following.items() if i != "s") for following in _NEXT)
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Node:
    """An edit in the tree of back pointers. `uses` counts the edits that follow it and the survivors that end here."""
    __slots__ = ("text", "parent", "uses", "depth")

    def __init__(self, text: str, parent: _Node | None):
        self.text, self.parent, self.uses, self.depth = text, parent, 1, 0
        if parent is not None:
            parent.uses += 1
            self.depth = parent.depth + 1


def _release(node: _Node | None) -> None:
    """Give up one use; a node without uses goes, and with it its use of its parent."""
    while node is not None:
        node.uses -= 1
        if node.uses:
            return
        node = node.parent


def _smaller(node: _Node, text: str, other: _Node, other_text: str) -> bool:
    """Whether one path and its next edit sort before another: compared from their common ancestor on."""
    left, right = [text], [other_text]
    while node is not other:
        if node.depth >= other.depth:
            left.append(node.text)
            node = node.parent
        else:
            right.append(other.text)
            other = other.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Survivors:
    """The cheapest path to each state, as far as it is undecided; `out` gets the edits that all of them share."""

    def __init__(self, state: int = START, insert: bool = True):
        self.root = _Node("", None)
        self.best: dict[int, tuple[int, _Node]] = {state: (0, self.root)}
        self.out: list[str] = []
        if insert:
            self._insert()

    def row(self, initial: str, fault: str) -> None:
        """Take a row in, with any insertions after it."""
        self.step(_moves(initial, fault))
        self._insert()
        self._prune()
        self._settle()

    def block(self, moves: Iterable[tuple[int, int, int, str]]) -> None:
        """Take in a block of rows, insertions included."""
        self.step(moves)
        self._prune()
        self._settle()

    def step(self, moves: Iterable[tuple[int, int, int, str]]) -> None:
        """Lengthen every path by one of `moves`: (from state, to state, cost, edit)."""
        found: dict[int, tuple[int, _Node, str]] = {}
        for was, to, cost, text in moves:
            if was in self.best:
                total, node = self.best[was]
                total += cost
                if to not in found or total < found[to][0] or total == found[to][0] and _smaller(node, text, *found[to][1:]):
                    found[to] = (total, node, text)
        new = {to: (total, _Node(text, node)) for to, (total, node, text) in found.items()}
        for _, node in self.best.values():
            _release(node)
        self.best = new

    def _insert(self) -> None:
        # no path needs more than two insertions in a row
        for _ in range(2):
            for state in list(self.best):
                total, node = self.best[state]
                to, total = _SPLICE[state], total + INSERT
                old = self.best.get(to)
                if old is None or total < old[0] or total == old[0] and _smaller(node, "I", old[1], ""):
                    self.best[to] = (total, _Node("I", node))
                    if old:
                        _release(old[1])

    def _prune(self) -> None:
        if ASSISTANT in self.best:
            least = self.best[ASSISTANT][0]
            for state, more in ((START, DELETE), (SYSTEM, 0)):
                if state in self.best and self.best[state][0] > least + more:
                    _release(self.best.pop(state)[1])

    def _settle(self) -> None:
        """Hand out the edits that no survivor can change any more: down to the first node with two uses."""
        if self.root.uses > 1:
            return
        at, path = next(iter(self.best.values()))[1], []
        while at is not self.root:
            path.append(at)
            at = at.parent
        for node in reversed(path):
            if self.root.uses > 1:
                break
            self.out.append(node.text)
            node.parent, self.root = None, node

    def suffix(self, state: int) -> list[str]:
        """The undecided edits of the path to a state."""
        edits, at = [], self.best[state][1]
        while at is not self.root:
            edits.append(at.text)
            at = at.parent
        return edits[::-1]

    def taken(self) -> list[str]:
        """The edits decided since the last call."""
        out, self.out = self.out, []
        return out

    def finish(self) -> tuple[int, list[str]]:
        """Cost of the cheapest path to an end, and the rest of its edits."""
        (cost, node), last = self.best[ASSISTANT], ASSISTANT
        if START in self.best:
            total, other = self.best[START]
            if total < cost or total == cost and _smaller(other, "", node, ""):
                cost, last = total, START
        return cost, self.taken() + self.suffix(last)


def _moves(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """What may happen to a row in each state."""
    moves = [(state, state, DELETE, "D") for state in range(4)]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        moves += [(state, _SPLICE[state], REROLE + extra, "R") for state in range(4)]
        moves += [(state, _NEXT[state][initial], extra, "K") for state in range(4) if initial in _NEXT[state]]
    return moves


def _fault(text: str) -> str:
    kept = text.rstrip(_SPACE)
    return "blank" if not kept else "" if kept[-1] in _ENDS else "truncated"


class _Turns:
    """Applies edits to the rows of one conversation, in order: the digest of the repaired turns, and the turns if wanted."""

    def __init__(self, wanted: bool):
        self.state, self.digest, self.number, self.wanted = START, hashlib.sha256(), 0, wanted
        self.made: list[tuple[int, str, str]] = []
        self.audit: list[str] = []

    def _turn(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.number else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.number += 1
        if self.wanted:
            self.made.append((self.number, role, text))

    def insert(self) -> None:
        self.audit.append("I")
        self.state = _SPLICE[self.state]
        self._turn(_ROLES[self.state], "")

    def row(self, edit: str, role: str, text: str) -> None:
        self.audit.append(edit)
        if edit == "K":
            self.state = _NEXT[self.state][role[:1]]
            self._turn(role, text)
        elif edit == "R":
            self.state = _SPLICE[self.state]
            self._turn(_ROLES[self.state], text)


@dataclass
class _Counts:
    """Faults, turns and illegal neighbours of rows in order; those of neighbouring parts add up."""
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str = ""
    last: str = ""

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.join(_Counts(1, fault == "blank", fault == "duplicate", fault == "truncated", 0, turn is not None, turn, turn, initial, initial))

    def join(self, after: _Counts) -> None:
        if self.rows and after.rows:
            self.illegal += self.last + after.first not in ("su", "ua", "au")
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if after.low is not None:
            self.turns += after.turns - (self.high == after.low)
            self.low, self.high = after.low if self.low is None else self.low, after.high
        if after.rows:
            self.first, self.last = self.first if self.rows else after.first, after.last
        self.rows += after.rows

    def facts(self, cost: int) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(zip(FACTS, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost), strict=True))


def repair_rows(rows: Iterable[tuple[int | None, str, str]], wanted: bool = False) -> tuple[dict[str, object], list[tuple[int, str, str]]]:
    """Facts, audit and digest of a whole conversation from its rows (turn, role, text) in order, and its repaired turns."""
    counts, search, turns, seen = _Counts(), Survivors(), _Turns(wanted), set()
    waiting: deque[tuple[str, str]] = deque()  # rows whose edit is not decided yet

    def apply(edits: Iterable[str]) -> None:
        for edit in edits:
            turns.insert() if edit == "I" else turns.row(edit, *waiting.popleft())

    for turn, role, text in rows:
        fault = _fault(text)
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        fault = "duplicate" if fault != "blank" and mark in seen else fault
        seen.add(mark)
        counts.add(turn, role[:1], fault)
        waiting.append((role, text))
        search.row(role[:1], fault)
        apply(search.taken())
    cost, rest = search.finish()
    apply(rest)
    return {**counts.facts(cost), "audit": "".join(turns.audit), "repaired_sha256": turns.digest.hexdigest()}, turns.made


def damage(df: DataFrame) -> DataFrame:
    """Conversation rows after the damage of the contract: (conv_id, turn, role, text, gone). A dropped row stays as a mark."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind, copies = F.col("kind"), F.when(F.col("kind") == 3, 2).otherwise(1)
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (df.select("conv_id", F.col("turn").cast("long").alias("turn"), key("role").alias("role"), key("text").alias("text"),
                      (F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))) % 20).alias("kind"))
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    (kind == 0).alias("gone"), F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy"))


def as_they_are(df: DataFrame) -> DataFrame:
    """Conversation rows for `repair` without any damage."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return df.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role"), filled("text"), F.lit(False).alias("gone"))


def repair(rows: DataFrame) -> DataFrame:
    """A row for each conversation: conv_id, the facts, the audit and the digest of the repaired turns."""
    return _repair(rows, False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, number (from 1), role, text."""
    return _repair(rows, True)


def _repair(rows: DataFrame, wanted: bool) -> DataFrame:
    prepared(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    out = (f"conv_id {kind}, " + ", ".join(f"{f} long" for f in FACTS) + ", audit string, repaired_sha256 string, "
           "at long, turn long, role string, text string, fault string, gone boolean")
    order = ["conv_id", "turn", "role", "mark", "nth"]
    # the last column tells equal rows apart, so that even they can lie in several slices
    dealt = (rows.select("conv_id", "turn", "role", "text", "gone", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("nth"))
             .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "gone"))
    found = session.staged(dealt.mapInArrow(lambda batches: _slices(batches, wanted), out), "conversations")
    done = _DONE if not wanted else ["conv_id", F.col("turn").alias("number"), "role", "text"]
    whole, edges = found.filter("at is null").select(*done), found.filter("at is not null")
    return whole.unionByName(_across(edges, kind, wanted).select(*done))


_DONE = ["conv_id", *FACTS, "audit", "repaired_sha256"]
_TYPES = {**{f: pa.int64() for f in FACTS}, "audit": pa.string(), "repaired_sha256": pa.string(), "at": pa.int64(), "turn": pa.int64(),
          "role": pa.string(), "text": pa.string(), "fault": pa.string(), "gone": pa.bool_()}


def _rows(batches: Iterator[pa.RecordBatch], kinds: list[pa.DataType]) -> Iterator[dict]:
    for batch in batches:
        kinds[:] = [batch.schema.field("conv_id").type]
        yield from batch.to_pylist()


def _written(rows: Iterator[dict], kinds: list[pa.DataType], types: dict[str, pa.DataType], size: int = 1024) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, pa.schema([("conv_id", kinds[0]), *types.items()]))


def _finished(conv: object, facts: dict, made: list[tuple[int, str, str]], wanted: bool) -> Iterator[dict]:
    if wanted:
        yield from ({"conv_id": conv, "turn": number, "role": role, "text": text} for number, role, text in made)
    else:
        yield {"conv_id": conv, **facts}


def _slices(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
    """Finish the conversations inside a slice; pass on the rows of its first and last one, numbered in their order."""
    part, kinds = TaskContext.get().partitionId() << 33, []

    def walk() -> Iterator[dict]:
        number = 0
        for i, (conv, group) in enumerate(groupby(_rows(batches, kinds), key=lambda r: r["conv_id"])):
            if i > 1:
                live = [(r["turn"], r["role"], r["text"]) for r in held if not r["gone"]]
                yield from _finished(held[0]["conv_id"], *repair_rows(live, wanted), wanted)
            held = []
            for row in group:
                number += 1
                row |= {"at": part + number, "fault": _fault(row["text"])}
                if i:
                    held.append(row)
                else:
                    yield row
        if number:
            yield from held

    return _written(walk(), kinds, _TYPES)


def _across(edges: DataFrame, kind: str, wanted: bool) -> DataFrame:
    """Conversations that may lie across slices, of any size."""
    live = edges.filter(~F.col("gone"))
    # at is unique: neither side of this join has a hot key, however often a conversation repeats a text
    firsts = live.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    faults = F.when((F.col("fault") != "blank") & F.col("new").isNull(), "duplicate").otherwise(F.col("fault")).alias("fault")
    narrow = session.staged(live.select("conv_id", "at", "turn", F.substring("role", 1, 1).alias("initial"), "fault").join(firsts, "at", "left")
                            .select("conv_id", "at", "turn", "initial", faults), "conversation-rows")
    moves = "array<struct<was:bigint,to:bigint,cost:bigint,text:string>>"
    blocks = (narrow.repartitionByRange("at").sortWithinPartitions("at").select("conv_id", "at", "turn", "initial", "fault")
              .mapInArrow(_blocks, f"conv_id {kind}, at long, counts struct<{_COUNTED}>, moves {moves}"))
    part = f"conv_id {kind}, at long, kind int, edits string, role string, text string, " + ", ".join(f"{f} long" for f in FACTS)
    chosen = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_choose, part)
    turns = live.select("conv_id", "at", F.lit(1).alias("kind"), "role", "text")
    marks = edges.filter("gone").select("conv_id").distinct().withColumn("at", F.lit(_LAST)).withColumn("kind", F.lit(3))
    ordered = chosen.unionByName(turns, True).unionByName(marks, True).repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return ordered.mapInArrow(lambda batches: _apply(batches, wanted), f"conv_id {kind}, " + ", ".join(f"{n} {_SQL[t]}" for n, t in _TYPES.items()))


_LAST = 2**63 - 1
_SQL = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}
_COUNTED = "rows:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,turns:bigint,low:bigint,high:bigint,first:string,last:string"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search blocks of rows from every state: what it costs to get from one state to another, and by which edits."""
    kinds: list[pa.DataType] = []

    def walk() -> Iterator[dict]:
        for conv, group in groupby(_rows(batches, kinds), key=lambda r: r["conv_id"]):
            while block := list(islice(group, BLOCK)):
                counts, moves = _Counts(), []
                for r in block:
                    counts.add(r["turn"], r["initial"], r["fault"])
                for state in range(4):
                    search = Survivors(state)
                    for r in block:
                        search.row(r["initial"], r["fault"])
                    shared = "".join(search.taken())
                    moves += [{"was": state, "to": to, "cost": cost, "text": shared + "".join(search.suffix(to))}
                              for to, (cost, _) in search.best.items()]
                yield {"conv_id": conv, "at": block[0]["at"], "counts": {n: int(v) if isinstance(v, bool) else v for n, v in vars(counts).items()},
                       "moves": moves}

    long = pa.int64()
    counted = pa.struct([(n, pa.string() if n in ("first", "last") else long) for n in _Counts.__dataclass_fields__])
    move = pa.struct([("was", long), ("to", long), ("cost", long), ("text", pa.string())])
    return _written(walk(), kinds, {"at": long, "counts": counted, "moves": pa.list_(move)}, 16)


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the blocks of each conversation: the edits of every block (kind 0), and the facts (kind 2)."""
    kinds: list[pa.DataType] = []

    def walk() -> Iterator[dict]:
        for conv, group in groupby(_rows(batches, kinds), key=lambda r: r["conv_id"]):
            counts, search, waiting = _Counts(), Survivors(insert=False), deque()  # a block inserts before its first row itself
            for r in group:
                counts.join(_Counts(**r["counts"]))
                waiting.append(r["at"])
                search.block([(m["was"], m["to"], m["cost"], m["text"]) for m in r["moves"]])
                for edits in search.taken():
                    yield {"conv_id": conv, "at": waiting.popleft(), "kind": 0, "edits": edits}
            cost, rest = search.finish()
            for edits in rest:
                yield {"conv_id": conv, "at": waiting.popleft(), "kind": 0, "edits": edits}
            yield {"conv_id": conv, "at": _LAST, "kind": 2, **counts.facts(cost)}

    return _written(walk(), kinds, {"at": pa.int64(), "kind": pa.int32(), "edits": pa.string(), "role": pa.string(), "text": pa.string(),
                                    **{f: pa.int64() for f in FACTS}}, 16)


def _apply(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
    """Stream the rows of each conversation past their edits."""
    kinds: list[pa.DataType] = []

    def walk() -> Iterator[dict]:
        for conv, group in groupby(_rows(batches, kinds), key=lambda r: r["conv_id"]):
            turns, edits, facts = _Turns(wanted), deque(), dict.fromkeys(FACTS, 0)
            for r in group:
                if r["kind"] == 0:
                    edits.extend(r["edits"])
                elif r["kind"] == 1:
                    while edits[0] == "I":
                        turns.insert()
                        edits.popleft()
                    turns.row(edits.popleft(), r["role"], r["text"])
                    if wanted:
                        yield from _finished(conv, {}, turns.made, True)
                        turns.made.clear()
                elif r["kind"] == 2:
                    facts = {f: r[f] for f in FACTS}
            while edits:
                turns.insert()
                edits.popleft()
            yield from _finished(conv, {**facts, "audit": "".join(turns.audit), "repaired_sha256": turns.digest.hexdigest()}, turns.made, wanted)

    return _written(walk(), kinds, _TYPES)
