"""Conversation structure repair by survivor-coalescence Viterbi.

The cheapest edits that turn a conversation's roles into an optional system
turn followed by user / assistant pairs (initials ``(s?(ua)+)?``): keep a row
(K, cost 0), give it the other role (R, 1), delete it (D, 2; required for
blank and duplicate rows) or insert an empty turn (I, 5); a truncated row that
stays costs 5 more. Of equally cheap edits the ones whose initials come first
in ASCII order are taken.

The Viterbi step over a row keeps one survivor a state. Survivors are leaves
of a tree of back pointers with reference counts: a node without references is
freed, and once all survivors share an ancestor the edits up to it are final
and leave the tree, so memory is bounded by the unresolved stretch (a survivor
that another one can replace at less cost, whatever follows, is none). Survivors
of equal cost are told apart by their complete unresolved edits. Their order is
kept as a rank: the edits of two survivors up to one row differ before their
end (both end in that row's own edit), so extending them can't reorder them.

Conversations may have any length: rows are range-sorted, a conversation is
cut into blocks of at most ``BLOCK_ROWS`` rows, and all blocks are summarised
in parallel: for every state a block can be entered in, the cheapest cost and
the rank of every state it can be left in. The same Viterbi then runs over the
blocks of a conversation (a few numbers each), and every block is run again
from its final entry to its final exit. No task holds a conversation, and the
Viterbi passes read no text.

Defined results: a null role or text counts as one space, a null turn comes
first, rows of one turn are ordered by role and text; equal rows are counted,
not multiplied. A null conversation id is a conversation like others. Roles
are judged by their first character; a row with an empty role can't be kept as
it is. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from newsloom.llm.common import shared_table, shuffle_partitions

#: Rows of a block.
BLOCK_ROWS = 512
#: Blocks that a task turns into Python values at a time.
SLICE = 256
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system turn, after a user turn, after an
# assistant turn.
EMPTY, SYSTEM, ASKED, DONE = range(4)
#: Turn that an insertion or another role gives in each state, and the state after it.
NEXT = {EMPTY: ("user", ASKED), SYSTEM: ("user", ASKED), ASKED: ("assistant", DONE), DONE: ("user", ASKED)}
#: Insertions that complete a conversation that ends in a state.
TO_END = {EMPTY: 0, SYSTEM: 2, ASKED: 1, DONE: 0}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: By how much the rest of a conversation can cost more from the first state
#: than from the second, at most: an insertion changes a state, a system row
#: that only EMPTY may keep is deleted, and an end that EMPTY has for nothing
#: takes two insertions from SYSTEM.
GAP = {(EMPTY, SYSTEM): 0, (EMPTY, ASKED): 5, (EMPTY, DONE): 10, (SYSTEM, EMPTY): 12, (SYSTEM, ASKED): 5, (SYSTEM, DONE): 10,
       (ASKED, EMPTY): 7, (ASKED, SYSTEM): 5, (ASKED, DONE): 5, (DONE, EMPTY): 2, (DONE, SYSTEM): 0, (DONE, ASKED): 5}
LEGAL = ("su", "ua", "au")


def _steps(symbol: str) -> tuple:
    """For each state, the cheapest ``(edits, cost, state after)`` of one row
    to every state after it, insertions before the row included. Insertions
    before a deleted row come first in no best repair: behind it they cost
    the same and sort lower."""
    initial, stays, extra = symbol.lower(), symbol != "x", TRUNCATED * symbol.isupper()
    out = []
    for state in NEXT:
        best = {state: (DELETE, "D")}
        at = state
        for n in range(3):
            ways = []
            if stays and initial == "s" and at == EMPTY:
                ways.append((0, "K", SYSTEM))
            if stays and initial == NEXT[at][0][0]:
                ways.append((0, "K", NEXT[at][1]))
            if stays:
                ways.append((REROLE, "R", NEXT[at][1]))
            for cost, edit, after in ways:
                found = (n * INSERT + cost + extra, "I" * n + edit)
                best[after] = min(best.get(after, found), found)
            at = NEXT[at][1]
        out.append(tuple((edits, cost, after) for after, (cost, edits) in best.items()))
    return tuple(out)


#: Rows by symbol: the initial (``o``: none of s, u, a), upper case where
#: truncated, ``x`` where the row must go.
STEPS = {c: _steps(c) for c in "suaoSUAOx"}


class _Node:
    """``refs`` counts the children and the survivor that stand on a node."""

    __slots__ = ("parent", "edits", "refs", "children")

    def __init__(self, parent, edits):
        self.parent, self.edits, self.refs, self.children = parent, edits, 0, []


class Survivors:
    """Viterbi over steps given one by one, entered in the state ``entry`` at
    cost 0. Edits that are final are handed to ``emit`` in order as
    ``(state before, edits, state after)``."""

    def __init__(self, entry: int, emit: Callable[[tuple], None] | None = None):
        self.emit, self.root, self.held = emit, _Node(None, None), 0
        self.root.refs = 1
        self.now = {entry: (0, 0, self.root)}  # state: (cost, rank, node)

    def step(self, steps) -> None:
        """``steps[state]``: ``(edits, cost, state after)``; edits of one
        state differ from each other and compare in their final order."""
        best: dict[int, tuple] = {}
        for state, (cost, rank, _) in self.now.items():
            for edits, more, after in steps[state]:
                found = (cost + more, rank, edits, state)
                if after not in best or found < best[after]:
                    best[after] = found
        # No repair goes through a state that another one can replace at less cost, whatever follows.
        costs = [(state, found[0]) for state, found in best.items()]
        for state, cost in costs:
            if any(less + GAP[other, state] < cost for other, less in costs if other != state):
                del best[state]
        old, self.now = self.now, {}
        for rank, after in enumerate(sorted(best, key=lambda t: best[t][1:3])):
            cost, _, edits, state = best[after]
            parent = old[state][2]
            node = _Node(parent, (state, edits, after))
            node.refs = 1
            parent.refs += 1
            parent.children.append(node)
            self.held += 1
            self.now[after] = (cost, rank, node)
        for _, _, node in old.values():
            self._release(node)
        self._settle()

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            parent.refs -= 1
            self.held -= 1
            node = parent

    def _settle(self) -> None:
        # A root with one reference, to a child, is behind every survivor.
        while self.root.refs == 1 and self.root.children:
            child = self.root.children[0]
            if self.emit is not None:
                self.emit(child.edits)
            child.parent = None
            self.root = child
            self.held -= 1

    def finish(self, state: int) -> None:
        """The path to ``state`` is the final one: emit what is unresolved."""
        for other, (_, _, node) in list(self.now.items()):
            if other != state:
                self._release(node)
                del self.now[other]
        self._settle()


def run_block(symbols: str, entry: int, emit=None) -> Survivors:
    """Survivors after the rows of a block. Copies behind a row go in every
    repair and change neither state nor order, so they are left out."""
    run = Survivors(entry, emit)
    for symbol in symbols:
        run.step(STEPS[symbol])
    return run


def _paths(symbols: str, copies: int, entries) -> list[int]:
    flat = []
    for entry in entries:
        for state, (cost, rank, _) in run_block(symbols, entry).now.items():
            flat += [entry, state, cost + copies * DELETE, rank]
    return flat


@dataclass
class Repair:
    """``rows``: every distinct row with its edits, in the order of ``part,
    block, idx``: ``conv_id, turn, role, text, times, edits, new_role`` (null:
    deleted) and ``inserted`` (roles of turns put before it); one row more for
    turns put at a conversation's end. ``totals``: one row a conversation."""

    rows: DataFrame
    totals: DataFrame


def _key(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _dealt(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number ``times``, range-sorted and cut into
    blocks, written once: the place ``(part, block, idx)`` orders them.
    ``opens``: surely a conversation's first row (the first row of a part may
    be one, too)."""
    counted = (rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                           F.coalesce("text", F.lit(" ")).alias("text"), F.col("times").cast("long").alias("times"))
               .groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times")))
    order = ["conv_id", "turn", "role", "text"]
    placed = (counted.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id())
              .withColumn("digest", F.unhex(F.sha2("text", 256))))
    schema = ", ".join([f"conv_id {_key(placed, 'conv_id')}", f"turn {_key(placed, 'turn')}",
                        "role string, text string, times long, part int, digest binary, block int, idx int, opens boolean"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, idx, last, started = 0, -1, None, False
        for batch in batches:
            blocks, places, opens = [], [], []
            for conv in batch.column("conv_id").to_pylist():
                idx += 1
                new = started and conv != last
                if new or idx == BLOCK_ROWS:
                    block, idx = block + 1, 0
                last, started = conv, True
                blocks.append(block)
                places.append(idx)
                opens.append(new)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks, pa.int32()), pa.array(places, pa.int32()), pa.array(opens, pa.bool_())],
                names=[*batch.schema.names, "block", "idx", "opens"])

    return shared_table(placed.mapInArrow(cut, schema))


def _blocks(dealt: DataFrame) -> DataFrame:
    """One row a block: its rows' symbols and numbers, in order."""
    place = ["part", "block", "idx"]
    solid = F.rtrim("text", F.lit(BLANKS))
    narrow = dealt.select("conv_id", "turn", "role", "times", "digest", "opens", *place, (solid == "").alias("blank"),
                          (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"),
                          F.substring("role", 1, 1).alias("initial"))
    firsts = (narrow.filter("NOT blank").groupBy("conv_id", "role", "digest")
              .agg(F.min(F.struct(*place)).alias("p")).select("p.*", F.lit(True).alias("first")))
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    stays = F.coalesce("first", F.lit(False))
    symbol = F.when(~stays, "x").when(F.col("cut"), F.upper(known)).otherwise(known)
    marked = narrow.join(firsts, place, "left").select(
        "conv_id", *place, "opens", "turn", "initial", "times", symbol.alias("symbol"),
        F.when(F.col("blank"), F.col("times")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).otherwise(F.col("times") - stays.cast("long")).alias("duplicate"),
        (stays & F.col("cut")).cast("long").alias("truncated"))
    row = F.struct("idx", "symbol", "initial", "times", "turn")
    return shared_table(marked.groupBy("conv_id", "part", "block").agg(
        F.sort_array(F.collect_list(row)).alias("rows"), F.max("opens").alias("opens"), F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated")))


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE).to_pylist()


def _summaries(blocks: DataFrame) -> DataFrame:
    """Per block: its paths, its adjacent illegal initials, and what joining
    it with its neighbours takes."""
    conv, turn = _key(blocks, "conv_id"), blocks.schema["rows"].dataType.elementType["turn"].dataType.simpleString()
    schema = (f"conv_id {conv}, part int, block int, blank long, duplicate long, truncated long, paths array<long>, "
              f"illegal long, head string, tail string, low {turn}, high {turn}, turns long, head_turn {turn}, tail_turn {turn}")
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _values(batches):
            out = []
            for b in found:
                rows, opens = b.pop("rows"), b.pop("opens")
                initials = [r["initial"] for r in rows]
                pairs = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))
                copies = sum(r["times"] - 1 for r in rows)
                turns = {r["turn"] for r in rows} - {None}
                paths = _paths("".join(r["symbol"] for r in rows), copies, (EMPTY,) if opens else NEXT)
                out.append(b | {"paths": paths, "illegal": pairs + copies, "head": initials[0], "tail": initials[-1],
                                "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(turns),
                                "head_turn": rows[0]["turn"], "tail_turn": rows[-1]["turn"]})
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return blocks.mapInArrow(run, schema)


class _Conversation:
    """Viterbi over the blocks of one conversation, in order."""

    def __init__(self, emit):
        self.run = Survivors(EMPTY, emit)
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, b: dict) -> None:
        steps = {state: [] for state in NEXT}
        flat = b["paths"]
        for at in range(0, len(flat), 4):
            entry, after, cost, rank = flat[at:at + 4]
            steps[entry].append(((rank, b["part"], b["block"]), cost, after))
        self.run.step(steps)
        for name in self.sums:
            self.sums[name] += b[name]
        if b["low"] is not None:
            self.low = b["low"] if self.low is None else min(self.low, b["low"])
            self.high = b["high"] if self.high is None else max(self.high, b["high"])
            self.turns += b["turns"]
        if self.last is not None:
            self.sums["illegal"] += self.last["tail"] + b["head"] not in LEGAL
            self.turns -= b["head_turn"] is not None and self.last["tail_turn"] == b["head_turn"]
        self.last = b

    def end(self) -> dict:
        cost, _, state = min((cost + INSERT * TO_END[s], rank, s) for s, (cost, rank, _) in self.run.now.items())
        self.run.finish(state)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.sums | {"conv_id": self.last["conv_id"], "part": self.last["part"], "block": self.last["block"],
                            "exit": state, "gaps": min(gaps, 2 ** 63 - 1), "cost": cost}


def _chain(summaries: DataFrame) -> DataFrame:
    """The final ``entry`` and ``exit`` of every block, and for every
    conversation one row with its totals (``entry`` null, ``exit`` its last
    state). Blocks stream past in order; unresolved ones are held only."""
    schema = (f"conv_id {_key(summaries, 'conv_id')}, part int, block int, entry int, exit int, gaps long, blank long, "
              "duplicate long, truncated long, illegal long, cost long")
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None

        def decided(edits) -> None:
            entry, (_, part, block), after = edits
            out.append({"part": part, "block": block, "entry": entry, "exit": after})

        for found in _values(batches):
            for b in found:
                if now is not None and now.last["conv_id"] != b["conv_id"]:
                    out.append(now.end())
                    now = None
                now = now or _Conversation(decided)
                now.add(b)
            yield pa.RecordBatch.from_pylist(out, schema=fields)
            out.clear()
        if now is not None:
            out.append(now.end())
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    ordered = summaries.repartition(shuffle_partitions(summaries), "conv_id").sortWithinPartitions("conv_id", "part", "block")
    return shared_table(ordered.mapInArrow(run, schema))


def _edits(blocks: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every block run again between its final states: ``edits, new_role,
    inserted`` of each of its rows."""
    schema = "part int, block int, idx int, edits string, new_role string, inserted array<string>"
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _values(batches):
            out = []
            for b in found:
                path: list[tuple] = []
                survivors = run_block("".join(r["symbol"] for r in b["rows"]), b["entry"], path.append)
                survivors.finish(b["exit"])
                for r, (state, edits, _) in zip(b["rows"], path):
                    turns = []
                    for _ in range(edits.count("I")):
                        turns.append(NEXT[state][0])
                        state = NEXT[state][1]
                    out.append({"part": b["part"], "block": b["block"], "idx": r["idx"], "edits": edits, "inserted": turns,
                                "new_role": NEXT[state][0] if edits[-1] == "R" else None})
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return (blocks.select("part", "block", "rows").join(decisions, ["part", "block"])
            .select("part", "block", "rows", "entry", "exit").mapInArrow(run, schema))


def repair(rows: DataFrame) -> Repair:
    """Repair the conversations of ``rows`` (``conv_id, turn, role, text`` and
    ``times``, the number of copies of a row)."""
    dealt = _dealt(rows)
    blocks = _blocks(dealt)
    chained = _chain(_summaries(blocks))
    ends = chained.filter("entry IS NULL")
    edits = _edits(blocks, chained.filter("entry IS NOT NULL").select("part", "block", "entry", "exit"))
    # A turn that is put at the end comes behind the last row of its conversation.
    missing = F.expr(f"CASE exit WHEN {SYSTEM} THEN array('user', 'assistant') WHEN {ASKED} THEN array('assistant') "
                     "ELSE CAST(array() AS array<string>) END")
    tails = ends.select("conv_id", "part", "block", F.lit(2 ** 31 - 1).alias("idx"), missing.alias("inserted")) \
        .filter(F.size("inserted") > 0).withColumn("edits", F.repeat(F.lit("I"), F.size("inserted")))
    kept = F.when(F.endswith("edits", F.lit("K")), F.col("role")).otherwise(F.col("new_role"))
    full = (dealt.drop("digest", "opens").join(edits, ["part", "block", "idx"]).withColumn("new_role", kept)
            .unionByName(tails, allowMissingColumns=True))
    return Repair(full, ends.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` of a repair's rows. A conversation's
    hash is one sequence by nature; its rows stream past in order and only
    the hash's state and the edits are held."""
    own = F.when(F.col("new_role").isNotNull(), F.array(F.concat("new_role", F.lit(":"), "text"))).otherwise(F.array().cast("array<string>"))
    lines = rows.select("conv_id", "part", "block", "idx",
                        F.concat("edits", F.repeat(F.lit("D"), F.coalesce(F.col("times") - 1, F.lit(0)).cast("int"))).alias("audit"),
                        F.concat(F.transform("inserted", lambda r: F.concat(r, F.lit(":"))), own).alias("lines"))
    schema = f"conv_id {_key(rows, 'conv_id')}, audit string, repaired_sha256 string"
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        conv, hashed, audit, any_line = None, None, [], False
        for found in _values(batches):
            for r in found:
                if hashed is not None and r["conv_id"] != conv:
                    out.append({"conv_id": conv, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()})
                    hashed = None
                if hashed is None:
                    conv, hashed, audit, any_line = r["conv_id"], hashlib.sha256(), [], False
                audit.append(r["audit"])
                for line in r["lines"]:
                    hashed.update((("\n" if any_line else "") + line).encode())
                    any_line = True
            yield pa.RecordBatch.from_pylist(out, schema=fields)
            out.clear()
        if hashed is not None:
            out.append({"conv_id": conv, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    ordered = (lines.repartition(shuffle_partitions(rows), "conv_id")
               .sortWithinPartitions("conv_id", "part", "block", "idx"))
    return ordered.mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times`` after the damage that the hash of
    ``conv_id:turn`` (nulls: one space) picks: the row is dropped, emptied,
    loses its sentence ends, is repeated, becomes a user turn, or stays."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    picked = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), pick.alias("pick"))
    return picked.filter("pick <> 0").select(
        "conv_id", "turn", F.when(F.col("pick") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("pick") == 3, 2).otherwise(1).alias("times"))


def audit(conversations: DataFrame) -> DataFrame:
    """One row for every ``conv_id`` of ``conversations``: faults, cost and
    edits of the repair after :func:`damage`."""
    done = repair(damage(conversations))
    ids = conversations.select("conv_id").distinct()
    found = (done.totals.join(digests(done.rows).withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")))
             .drop("_id").withColumnRenamed("conv_id", "_conv"))
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
