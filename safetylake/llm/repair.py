"""Repair of broken conversations by generalised LR parsing over the role grammar.

A conversation is well formed if its roles read: an optional system turn, then
pairs of a user and an assistant turn, or nothing at all. Turns are parsed left
to right with an LR automaton built from that grammar. The parser keeps a
graph-structured stack: a stack is a node that names its LR state and the node
below it, equal stacks are one node, and each node carries the cheapest way to
reach it as (cost, audit), the audit being the initials of the edits so far.
Keep, Rerole, Delete and Insert move from node to node; where two ways meet in
one stack the smaller (cost, audit) stays. That is exact: two audits of equal
cost over the same turns never begin one another, as the longer one would have
paid for its further inserts, so their order does not change when both grow.

The grammar has five stacks, so the ways through any run of turns are a small
table (from stack, to stack) -> (cost, audit), and tables of neighbouring runs
compose. A conversation of any length is therefore cut into blocks of 512
turns; blocks are swept by different tasks and their tables folded in order.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby, islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .ranking import ranked

#: The role grammar; symbols are role initials (system, user, assistant) and rule names.
GRAMMAR: list[tuple[str, tuple[str, ...]]] = [
    ("Conversation", ()),
    ("Conversation", ("Head", "Pairs")),
    ("Head", ()),
    ("Head", ("s",)),
    ("Pairs", ("u", "a")),
    ("Pairs", ("Pairs", "u", "a")),
]
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Roles that an edit may give a turn, by initial.
GIVEN = {"u": "user", "a": "assistant"}
#: Turns swept at once.
BLOCK = 512
#: What counts as white space.
SPACE = " \t\n\x0b\x0c\r"

Best = tuple[int, str]


class Stacks:
    """The stacks that an LR parser of ``grammar`` can have between two terminals.

    ``moves[stack][terminal]`` is the next stack, ``accepting[stack]`` whether
    the input may end there; stack 0 is the empty one.
    """

    def __init__(self, grammar: list[tuple[str, tuple[str, ...]]], most: int = 64):
        self.rules = [("", (grammar[0][0],)), *grammar]
        names = {left for left, _ in grammar}
        self.follow = self._follow(names)
        start = self._closure({(0, 0)})
        states, self.goto = [start], [{}]
        for at, items in enumerate(states):             # grows as states are found
            for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                to = self._closure({(r, d + 1) for r, d in items if self.rules[r][1][d:d + 1] == (symbol,)})
                if to not in states:
                    states.append(to)
                    self.goto.append({})
                self.goto[at][symbol] = states.index(to)
        self.states = states
        self.below: list[tuple[int, int]] = []          # node -> (LR state, node below)
        self.known: dict[tuple[int, int], int] = {}
        root = self._node(0, -1)
        terminals = sorted({x for _, right in grammar for x in right if x not in names})
        found, self.moves, self.accepting = [root], [], []
        for node in found:
            self.accepting.append(self._reduced(node, "$") is None)
            moves = {}
            for t in terminals:
                to = self._shift(node, t)
                if to is not None:
                    if to not in found:
                        found.append(to)
                    moves[t] = found.index(to)
            self.moves.append(moves)
            if len(found) > most:
                raise ValueError("the grammar needs unboundedly many stacks")

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo, seen = list(items), set(items)
        while todo:
            r, d = todo.pop()
            symbol = self.rules[r][1][d:d + 1]
            for i, (left, _) in enumerate(self.rules):
                if (left,) == symbol and (i, 0) not in seen:
                    seen.add((i, 0))
                    todo.append((i, 0))
        return frozenset(seen)

    def _follow(self, names: set[str]) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {n: set() for n in names}
        follow: dict[str, set[str]] = {n: set() for n in names} | {"": {"$"}}
        before = None
        while before != (state := (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))):
            before = state
            for left, right in self.rules:
                if left and all(x in empty for x in right):
                    empty.add(left)
                for i, x in enumerate(right):
                    if left and all(y in empty for y in right[:i]):
                        first[left] |= first.get(x, {x})
                    if x in names:
                        for y in right[i + 1:]:
                            follow[x] |= first.get(y, {y})
                            if y not in empty:
                                break
                        else:
                            follow[x] |= follow[left]
        return follow

    def _node(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self.known:
            self.known[key] = len(self.below)
            self.below.append(key)
        return self.known[key]

    def _reduced(self, node: int, ahead: str) -> int | None:
        """The stack after all reductions before ``ahead``; None if the input is accepted there."""
        while True:
            state = self.below[node][0]
            if ahead in self.goto[state]:
                return node
            done = [r for r, d in self.states[state] if d == len(self.rules[r][1]) and ahead in self.follow[self.rules[r][0]]]
            if not done:
                return -1
            if len(done) > 1:
                raise ValueError("the grammar needs more than one token ahead")
            left, right = self.rules[done[0]]
            if not left:
                return None
            node = self._reduce(node, left, len(right))

    def _reduce(self, node: int, left: str, size: int) -> int:
        for _ in range(size):
            node = self.below[node][1]
        return self._node(self.goto[self.below[node][0]][left], node)

    def _shift(self, node: int, terminal: str) -> int | None:
        node = self._reduced(node, terminal)
        if node is None or node < 0:
            return None
        node = self._node(self.goto[self.below[node][0]][terminal], node)
        # a state that can only reduce does so at once, so equal prefixes share their stack
        while len(items := self.states[self.below[node][0]]) == 1:
            ((r, d),) = items
            left, right = self.rules[r]
            if d < len(right) or not left:
                break
            node = self._reduce(node, left, len(right))
        return node


ROLES = Stacks(GRAMMAR)

Front = dict[int, Best]


def _better(front: Front, stack: int, cost: int, audit: str) -> bool:
    held = front.get(stack)
    if held is None or (cost, audit) < held:
        front[stack] = (cost, audit)
        return True
    return False


def inserted(front: Front) -> Front:
    """The stacks reached by any number of inserts."""
    out = dict(front)
    todo = list(out)
    while todo:
        stack = todo.pop()
        cost, audit = out[stack]
        for t in GIVEN:
            to = ROLES.moves[stack].get(t)
            if to is not None and _better(out, to, cost + INSERT, audit + "I"):
                todo.append(to)
    return out


def edited(front: Front, initial: str, fault: str) -> Front:
    """The stacks after one turn, by every edit that its fault allows."""
    out: Front = {}
    more = TRUNCATED if fault == "truncated" else 0
    for stack, (cost, audit) in inserted(front).items():
        _better(out, stack, cost + DELETE, audit + "D")
        if fault not in ("blank", "duplicate"):
            to = ROLES.moves[stack].get(initial)
            if to is not None:
                _better(out, to, cost + more, audit + "K")
            for t in GIVEN:
                to = ROLES.moves[stack].get(t)
                if to is not None:
                    _better(out, to, cost + REROLE + more, audit + "R")
    return out


def swept(turns: list[tuple[str, str]], starts: Iterable[int]) -> dict[tuple[int, int], Best]:
    """The table of a run of turns ``(role initial, fault)``: (from stack, to stack) -> (cost, audit)."""
    table = {}
    for start in starts:
        front: Front = {start: (0, "")}
        for initial, fault in turns:
            front = edited(front, initial, fault)
        table |= {(start, to): best for to, best in front.items()}
    return table


def folded(tables: Iterable[dict[tuple[int, int], Best]]) -> Best:
    """Cheapest (cost, audit) of a whole conversation, given the tables of its blocks in order.

    What all stacks' audits begin with is set aside, so the strings compared stay short.
    """
    settled: list[str] = []
    front: Front = {0: (0, "")}
    for table in tables:
        out: Front = {}
        for (start, to), (cost, audit) in table.items():
            if start in front:
                c, a = front[start]
                held = out.get(to)
                if held is None or c + cost <= held[0]:
                    _better(out, to, c + cost, a + audit)
        shared = os.path.commonprefix([a for _, a in out.values()])
        settled.append(shared)
        front = {to: (c, a[len(shared):]) for to, (c, a) in out.items()}
    cost, audit = min(best for stack, best in inserted(front).items() if ROLES.accepting[stack])
    return cost, "".join([*settled, audit])


def lines(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The repaired turns ``(role, text, edit)`` of one conversation, given its edits and its turns in order."""
    edits, stack = iter(audit), 0

    def given() -> str:
        # the grammar leaves one choice for a turn whose role an edit gives
        return next(t for t in GIVEN if t in ROLES.moves[stack])

    for role, text in turns:
        for edit in edits:
            if edit != "I":
                break
            t = given()
            stack = ROLES.moves[stack][t]
            yield GIVEN[t], "", "I"
        else:
            raise ValueError("fewer edits than turns")
        if edit != "D":
            t = role[:1] if edit == "K" else given()
            stack = ROLES.moves[stack][t]
            yield role if edit == "K" else GIVEN[t], text, edit
    for edit in edits:
        t = given()
        stack = ROLES.moves[stack][t]
        yield GIVEN[t], "", edit


# --- Spark ----------------------------------------------------------------------------------------

def _rows(batches: Iterator) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _sent(rows: Iterator[tuple], schema, size: int = 256) -> Iterator:
    import pyarrow as pa

    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after planted damage; null roles and texts are one space.

    By the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 takes out ``.!?``, 3 repeats the row, 4 makes its role user.
    """
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    role = F.when(kind == 4, "user").otherwise(shown("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (turns.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies))
            .drop("col"))


def _turns(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def faults(turns: DataFrame) -> DataFrame:
    """One row a turn: conversation ``c``, place ``_rank``, turn ``t``, role ``initial`` and first ``fault`` ('' if none).

    Turns are ordered by turn (nulls first), ties by role, then text. The first of
    equal turns is found by an aggregate joined back on (conversation, place).
    """
    body = F.rtrim("text", F.lit(SPACE))
    rows = _turns(turns).select(
        "c", "t", "role", "text", F.substring("role", 1, 1).alias("initial"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same"))
    rows = staged(ranked(rows, ["c"], ["t", "role", "text"], "repair-turns", drop=("role", "text")), "repair-ranked")
    firsts = rows.groupBy("c", "same").agg(F.min("_rank").alias("f")).select(F.col("c").alias("fc"), "f")
    return (rows.join(firsts, F.col("c").eqNullSafe(F.col("fc")) & (F.col("_rank") == F.col("f")), "left")
            .select("c", "_rank", "t", "initial",
                    F.when(F.col("blank"), "blank").when(F.col("f").isNull(), "duplicate")
                    .when(F.col("cut"), "truncated").otherwise("").alias("fault")))


COUNTED = ("blank", "duplicate", "truncated")


def _swept_blocks(batches: Iterator, schema) -> Iterator:
    def out():
        for (c, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            turns = [(r[3], r[4]) for r in rows]
            table = swept(turns, range(len(ROLES.moves)) if block else [0])
            illegal = sum((x[0] + y[0]) not in ("su", "ua", "au") for x, y in zip(turns, turns[1:]))
            counts = [sum(f == k for _, f in turns) for k in COUNTED]
            yield (c, block, turns[0][0], turns[-1][0], illegal, *counts, [k[0] for k in table], [k[1] for k in table],
                   [b[0] for b in table.values()], [b[1] for b in table.values()])

    return _sent(out(), schema)


def _folded_blocks(batches: Iterator, schema) -> Iterator:
    def out():
        for c, blocks in groupby(_rows(batches), key=lambda r: r[0]):
            totals, last = [0] * (1 + len(COUNTED)), None

            def tables():
                nonlocal last
                for b in blocks:
                    for i, n in enumerate(b[4:8]):
                        totals[i] += n
                    if last is not None and last + b[2] not in ("su", "ua", "au"):
                        totals[0] += 1
                    last = b[3]
                    yield {(x, y): (cost, audit) for x, y, cost, audit in zip(*b[8:12])}

            cost, audit = folded(tables())
            yield c, *totals, cost, audit

    return _sent(out(), schema)


def repairs(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row a conversation: ``conv_id``, ``gaps``, the fault counts, ``illegal``, ``cost``, ``audit``.

    ``conversations`` may name further ``conv_id`` that have no turns: zeros and
    an empty audit. Null ids are one conversation. Nulls in role or text read as
    one space. No turns give no rows. Further columns are not looked at.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = staged(faults(turns), "repair-faults")
    shape = (f"c {kind}, block bigint, first string, last string, illegal bigint, blank bigint, duplicate bigint, truncated bigint, "
             "start array<int>, stop array<int>, cost array<bigint>, audit array<string>")
    blocks = (rows.select("c", F.floor(F.col("_rank") / BLOCK).cast("bigint").alias("block"), "_rank", "initial", "fault")
              .repartition("c", "block").sortWithinPartitions("c", "block", "_rank"))
    tables = staged(_mapped(blocks, _swept_blocks, shape), "repair-tables")
    shape = f"c {kind}, illegal bigint, blank bigint, duplicate bigint, truncated bigint, cost bigint, audit string"
    found = _mapped(tables.repartition("c").sortWithinPartitions("c", "block"), _folded_blocks, shape)
    spans = (rows.where("t IS NOT NULL").select("c", "t").distinct().groupBy("c")
             .agg((F.max("t") - F.min("t") + 1 - F.count("t")).cast("bigint").alias("gaps")))
    every = found.unionByName(spans, allowMissingColumns=True)
    if conversations is not None:
        every = every.unionByName(conversations.select(F.col("conv_id").alias("c")), allowMissingColumns=True)
    return every.groupBy(F.col("c").alias("conv_id")).agg(
        *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in ("gaps", *COUNTED, "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"))


def _mapped(df: DataFrame, step, shape: str) -> DataFrame:
    """``step`` over each partition as a stream of batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(shape))

    def run(batches: Iterator) -> Iterator:
        return step(batches, schema)

    return df.mapInArrow(run, shape)


def _in_order(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's result followed by its turns, side by side in one partition."""
    head = found.select(F.col("conv_id").alias("c"), F.lit(0).alias("k"), F.struct(*found.columns).alias("found"))
    rows = _turns(turns).withColumn("k", F.lit(1))
    return (head.unionByName(rows, allowMissingColumns=True).select("c", "k", "found", "t", "role", "text")
            .repartition("c").sortWithinPartitions("c", "k", "t", "role", "text"))


def _conversations(batches: Iterator) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
        found = next(rows)[2]
        yield found, lines(found["audit"], ((r[4], r[5]) for r in rows))


def rewritten(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns ``(conv_id, place, role, text, edit)``, given ``repairs(turns)``. Inserted turns have
    empty texts. Turns pass through as a stream; no conversation is held whole."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def step(batches: Iterator, schema) -> Iterator:
        return _sent(((f["conv_id"], i, *line) for f, made in _conversations(batches) for i, line in enumerate(made)), schema)

    return _mapped(_in_order(turns, found), step, f"conv_id {kind}, place bigint, role string, text string, edit string")


def report(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``repairs(turns)`` with ``repaired_sha256``, the digest of the repaired ``role:text`` lines.

    A digest of one text can only be taken in order, so a conversation's lines
    pass through one task, as a stream; its faults and edits do not.
    """
    def digest(made: Iterator[tuple[str, str, str]]) -> str:
        h = sha256()
        for i, (role, text, _) in enumerate(made):
            h.update(f"{chr(10) * (i > 0)}{role}:{text}".encode("utf-8", "surrogatepass"))
        return h.hexdigest()

    def step(batches: Iterator, schema) -> Iterator:
        return _sent(((*f.values(), digest(made)) for f, made in _conversations(batches)), schema)

    return _mapped(_in_order(turns, found), step, found.schema.simpleString()[7:-1].replace(":", " ") + ", repaired_sha256 string")
