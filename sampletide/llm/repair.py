"""Structure of conversations, audited and repaired at least cost.

Rows of a conversation are kept, given the other role, deleted, or joined by inserted ones, until the initials of the roles
read `(s?(ua)+)?`. A dynamic programme over four states (nothing yet, after a system row, after a user row, after an
assistant row) keeps for every state the cheapest audit, the string of edits, and among equal costs the least one. Audits
are persistent: each is a node that adds one edit to a shared prefix and knows its ancestors 1, 2, 4, ... edits back and a
rolling hash. Two audits of equal cost are compared by searching their longest common prefix through these ancestors;
prefixes that the hashes call equal are verified.

A conversation may hold most of all rows. Rows are dealt by ranges of (conversation, turn), and a stretch of at most BLOCK
rows is solved from each of the four states. Of two audits in different states that have used up the same rows neither is a
prefix of the other, so their order is settled for good: stretches are chained by costs and ranks alone. Only the digest
of a repaired conversation, which is sequential by nature, is taken in one task, which streams the rows and holds none.
"""

from __future__ import annotations

from functools import cmp_to_key
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import SPACE, WORD_REGEX, travels

travels(__name__)

# Fixed costs of the edits.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = ("su", "ua", "au")
# Most rows and characters of a stretch.
BLOCK, CHARACTERS = 4096, 8_000_000
# Rows of a range.
RANGE = 100_000
_ROWS = 200

_BASE, _PRIME = 1_000_003, (1 << 61) - 1


# --- audits ----------------------------------------------------------------------------------------------

class Audit:
    """One edit after a shared prefix (none at the root)."""

    __slots__ = ("edit", "depth", "hash", "back")

    def __init__(self, edit: str = "", before: Audit | None = None):
        self.edit = edit
        self.depth, self.hash, self.back = 0, 0, []
        if before is not None:
            self.depth = before.depth + 1
            self.hash = (before.hash * _BASE + ord(edit)) % _PRIME
            # back[k] lies 2 ** k edits before.
            at, k = before, 0
            self.back.append(at)
            while len(at.back) > k:
                at = at.back[k]
                self.back.append(at)
                k += 1

    def at(self, depth: int) -> Audit:
        node, far = self, self.depth - depth
        k = 0
        while far:
            if far & 1:
                node = node.back[k]
            far >>= 1
            k += 1
        return node

    def text(self) -> str:
        found, node = [], self
        while node.depth:
            found.append(node.edit)
            node = node.back[0]
        return "".join(reversed(found))


def same(a: Audit, b: Audit) -> bool:
    """Equality of audits of one depth, edit by edit down to a shared node."""
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.back[0], b.back[0]
    return True


def compared(a: Audit, b: Audit) -> int:
    """-1, 0 or 1 as the text of `a` is less than, equal to or greater than that of `b`."""
    if a is b:
        return 0
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash == y.hash:
        if same(x, y):
            return (a.depth > b.depth) - (a.depth < b.depth)
    else:
        for k in reversed(range(len(x.back))):
            if k < len(x.back) and x.back[k].hash != y.back[k].hash:
                x, y = x.back[k], y.back[k]
        if same(x.back[0], y.back[0]):
            return (x.edit > y.edit) - (x.edit < y.edit)
    # The hashes of different prefixes collided.
    s, t = a.text(), b.text()
    return (s > t) - (s < t)


def cheaper(first, second):
    """The better of two (cost, audit), None being no audit at all."""
    if first is None or second is None:
        return first or second
    if first[0] != second[0]:
        return first if first[0] < second[0] else second
    return first if compared(first[1], second[1]) <= 0 else second


def _plus(found, cost: int, edit: str):
    return found and (found[0] + cost, Audit(edit, found[1]))


def stepped(states: list, initial: str, fault: int) -> list:
    """(cost, audit) of each state after one more row, rows inserted before it included."""
    before = inserted(states)
    after = [_plus(x, DELETE, "D") for x in before]
    if fault in (BLANK, DUPLICATE):
        return after
    more = LEFT_TRUNCATED if fault == TRUNCATED else 0
    for state in range(4):
        found = before[state]
        if not found:
            continue
        goal = ASSISTANT if state == USER else USER
        if initial == "ua"[goal == ASSISTANT]:
            after[goal] = cheaper(after[goal], _plus(found, more, "K"))
        else:
            after[goal] = cheaper(after[goal], _plus(found, more + REROLE, "R"))
        if state == START and initial == "s":
            after[SYSTEM] = cheaper(after[SYSTEM], _plus(found, more, "K"))
    return after


def inserted(states: list) -> list:
    """States after rows inserted where they stand; more than two in a row only lead back."""
    user = states[USER]
    for state in (START, SYSTEM, ASSISTANT):
        user = cheaper(user, _plus(states[state], INSERT, "I"))
    return [states[START], states[SYSTEM], user, cheaper(states[ASSISTANT], _plus(user, INSERT, "I"))]


def from_state(entry: int, rows: list[tuple[str, int]]) -> list:
    """(cost, audit) of each state after `rows` of (initial, fault), begun in state `entry`."""
    states: list = [None] * 4
    states[entry] = (0, Audit())
    for initial, fault in rows:
        states = stepped(states, initial, fault)
    return states


# Edits that end an audit in each state.
ENDINGS = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}


def ended(states: list):
    """(cost, audit) of the best end, or None."""
    best = None
    for state, ending in ENDINGS.items():
        found = states[state]
        for edit in ending:
            found = _plus(found, INSERT, edit)
        best = cheaper(best, found)
    return best


class Repaired:
    """Roles and digest of a repaired conversation, fed with edits and rows in turn."""

    def __init__(self):
        self.state, self.lines, self.hash = START, 0, sha256()

    def _line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _made(self, text: str) -> None:
        self._line("assistant" if self.state == USER else "user", text)
        self.state = ASSISTANT if self.state == USER else USER

    def feed(self, edits, rows) -> None:
        """`edits` in order; every edit but an insertion takes the next (role, text) of `rows`."""
        for edit in edits:
            if edit == "I":
                self._made("")
                continue
            role, text = next(rows)
            if edit == "K":
                self._line(role, text)
                self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            elif edit == "R":
                self._made(text)


# --- rows ------------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage of the contract: conv_id, turn, role, text, copy, live.

    A dropped row stays as a mark of its conversation that is not live.
    """
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                                (F.crc32(F.encode(key, "UTF-8")) % 20).alias("draw"))
    changed = F.when(F.col("draw") == 0, None).when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
                       F.explode(copies).alias("copy"), (F.col("draw") != 0).alias("live"))


def faults(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text, copy, live) with `place` (null turns first), `digest` of role and text, and
    `fault`, the first that applies.

    Rows of a conversation with the same role and text are counted first; only those that occur again are compared with
    their first place, so a row repeated endlessly is one aggregated row, never a group.
    """
    place = F.struct(F.col("turn").isNotNull().cast("int").alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "copy")
    marked = rows.withColumn("place", place).withColumn(
        "digest", F.when(F.col("live"), F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    again = (marked.where("live").groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min("place").alias("_first")).where("_n > 1"))
    both = marked.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(WORD_REGEX), BLANK).when(F.col("place") > F.col("_first"), DUPLICATE)
             .when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    return both.select("conv_id", "place", "role", "text", "live", "digest", fault.alias("fault"))


# --- stretches -------------------------------------------------------------------------------------------

_NUMBERS = ("blank", "duplicate", "truncated", "illegal")
_STRETCH = ("part int, block int, seq int, role string, text string, n long, blank long, duplicate long, truncated long, illegal long, "
            "turns long, low long, high long, first string, last string, costs array<long>, ranks array<int>, audits array<string>, gaps long, cost long, audit string, digest string")


class Tally:
    """Counts of a stretch of rows in order, or of stretches in order."""

    def __init__(self):
        self.n = self.turns = 0
        self.counts = dict.fromkeys(_NUMBERS, 0)
        self.low = self.high = None
        self.first = self.last = None

    def row(self, turn, role: str, fault: int) -> None:
        for kind, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated")):
            self.counts[name] += fault == kind
        one = int(turn is not None)
        self.joined(1, {}, one, turn, turn, role[:1], role[:1])

    def joined(self, n, counts, turns, low, high, first, last) -> None:
        if not n:
            return
        for name, k in counts.items():
            self.counts[name] += k
        if self.n and self.last + first not in LEGAL:
            self.counts["illegal"] += 1
        # Turns ascend, so only the last one met can come again.
        self.turns += turns - (turns > 0 and self.high is not None and low == self.high)
        if turns:
            self.low, self.high = low if self.low is None else self.low, high
        self.n, self.first, self.last = self.n + n, first if not self.n else self.first, last

    def gaps(self) -> int:
        return min(self.high - self.low + 1 - self.turns, 2 ** 63 - 1) if self.turns else 0

    def fields(self) -> dict:
        return {"n": self.n, **self.counts, "turns": self.turns, "low": self.low, "high": self.high, "first": self.first, "last": self.last}


def solved(rows: list[tuple[str, int]]) -> dict:
    """Costs, ranks and audits of a stretch, at 4 * entry + exit; null where no audit leads there."""
    costs, ranks, audits = [None] * 16, [None] * 16, [None] * 16
    for entry in range(4):
        states = from_state(entry, rows)
        ends = [s for s in range(4) if states[s]]
        ends.sort(key=cmp_to_key(lambda a, b: compared(states[a][1], states[b][1])))
        for rank, s in enumerate(ends):
            costs[4 * entry + s], ranks[4 * entry + s], audits[4 * entry + s] = states[s][0], rank, states[s][1].text()
    return {"costs": costs, "ranks": ranks, "audits": audits}


def _whole(tally: Tally, rows, lines) -> dict:
    cost, audit = ended(from_state(START, rows))
    made = Repaired()
    edits = audit.text()
    made.feed(edits, iter(lines))
    return {"gaps": tally.gaps(), "cost": cost, "audit": edits, "digest": made.hash.hexdigest()}


def _batches(schema: pa.Schema, rows):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows_of(batches, names):
    for batch in batches:
        for i in range(0, batch.num_rows, 128):
            part = batch.slice(i, 128)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def _stream(rows: DataFrame, task, schema: str) -> DataFrame:
    """`task(rows) -> dicts` over the rows of each task, which come as tuples in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = rows.sparkSession.createDataFrame([], schema).schema
    out, names = to_arrow_schema(fields), list(range(len(rows.columns)))
    return rows.mapInArrow(lambda batches: _batches(out, task(_rows_of(batches, names))), fields)


def stretches(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Conversations that lie inside one task's range and one block, whole (seq null); of all others the stretches (seq -1)
    and their rows (seq from 0). The number of ranges follows the rows."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE))
    order = ["conv_id", "live", "known", "turn", "role", "digest", "copy"]
    flat = rows.select("conv_id", "live", "place.known", "place.turn", "role", "digest", "place.copy", "fault", "text")
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = flat.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def task(every):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        state = {"conv": None, "any": False, "blocks": 0, "before": None}
        tally, held, size = Tally(), [], 0

        def flush(last):
            """The rows held, as a whole conversation if they surely are one."""
            nonlocal tally, held, size
            seen = [(r[1][:1], r[0]) for r in held]
            if not last and not state["blocks"] and not state["edge"]:
                yield {"conv_id": state["conv"], "part": part, **tally.fields(), **_whole(tally, seen, [r[1:] for r in held])}
            else:
                at = {"conv_id": state["conv"], "part": part, "block": state["blocks"]}
                yield at | {"seq": -1} | tally.fields() | solved(seen)
                for i, r in enumerate(held):
                    yield at | {"seq": i, "role": r[1], "text": r[2]}
            state["blocks"] += 1
            tally, held, size = Tally(), [], 0
        for conv, live, known, turn, role, digest, _, fault, text in every:
            if not state["any"] or conv != state["conv"]:
                if state["any"]:
                    # The first conversation of a range may have begun in another one.
                    yield from flush(last=False)
                state |= {"edge": not state["any"], "any": True, "conv": conv, "blocks": 0, "before": None}
            if not live:
                continue
            if len(held) == block or size > CHARACTERS:
                yield from flush(last=True)
            same_row = (known, turn, digest)
            if same_row == state["before"] and fault != BLANK:
                fault = DUPLICATE
            state["before"] = same_row
            tally.row(turn if known else None, role, fault)
            held.append((fault, role, text))
            size += len(text)
        if state["any"]:
            yield from flush(last=True)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(dealt, task, f"conv_id {kind}, {_STRETCH}")


def chained(found: DataFrame) -> DataFrame:
    """conv_id, part, block, entry, exit, total: the state in which the best audit enters and leaves every stretch, and
    its whole cost. Rows are a few numbers per stretch; a task keeps four states of each stretch of one conversation."""
    heads = found.where("seq = -1").select("conv_id", "part", "block", "costs", "ranks")
    dealt = heads.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def task(every):
        conv, begun, path, costs, ranks = None, False, [], {}, {}

        def best():
            ends = {s: costs[s] + INSERT * len(ENDINGS[s]) for s in costs}
            state = min(ends, key=lambda s: (ends[s], ranks[s]))
            total, out = ends[state], []
            for part, block, came in reversed(path):
                out.append({"conv_id": conv, "part": part, "block": block, "entry": came[state], "exit": state, "total": total})
                state = came[state]
            yield from reversed(out)
        for own, part, block, more, order in every:
            if not begun or own != conv:
                if begun:
                    yield from best()
                conv, begun, path, costs, ranks = own, True, [], {START: 0}, {START: 0}
            came = {}
            for s in range(4):
                open_ = [p for p in costs if more[4 * p + s] is not None]
                if open_:
                    came[s] = min(open_, key=lambda p: (costs[p] + more[4 * p + s], ranks[p]))
            path.append((part, block, came))
            after = sorted(came, key=lambda s: (ranks[came[s]], order[4 * came[s] + s]))
            costs = {s: costs[came[s]] + more[4 * came[s] + s] for s in came}
            ranks = {s: i for i, s in enumerate(after)}
        if begun:
            yield from best()
    kind = found.schema["conv_id"].dataType.simpleString()
    return _stream(dealt, task, f"conv_id {kind}, part int, block int, entry int, exit int, total long")


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def joined(found: DataFrame, chain: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several stretches, their rows streamed in order."""
    at = ["part", "block"]
    chosen = chain.select(F.col("conv_id").alias("_conv"), *[F.col(c).alias(f"_{c}") for c in at], "entry", "exit", "total")
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block"))
    numbers = ["n", *_NUMBERS, "turns", "low", "high", "first", "last"]
    heads = found.where("seq = -1").join(chosen, on).select(
        "conv_id", *at, "seq", F.lit(None).cast("string").alias("role"), F.expr("audits[4 * entry + exit]").alias("text"), *numbers, "exit", "total")
    lines = found.where("seq >= 0").select("conv_id", *at, "seq", "role", "text")
    every = heads.unionByName(lines, allowMissingColumns=True)
    dealt = every.repartition("conv_id").sortWithinPartitions("conv_id", *at, "seq")

    def task(rows):
        tally = made = conv = None
        pieces, edits, state, total = [], iter(""), START, 0

        def closed():
            ending = ENDINGS[state]
            made.feed([*edits, *ending], iter(()))
            return {"conv_id": conv, "gaps": tally.gaps(), **tally.counts, "cost": total, "audit": "".join(pieces) + ending,
                    "repaired_sha256": made.hash.hexdigest()}
        for own, _, _, seq, role, text, n, blank, duplicate, truncated, illegal, turns, low, high, first, last, end, cost in rows:
            if seq < 0:
                if made is None or own != conv:
                    if made is not None:
                        yield closed()
                    tally, made, conv, pieces, edits = Tally(), Repaired(), own, [], iter("")
                tally.joined(n, dict(zip(_NUMBERS, (blank, duplicate, truncated, illegal), strict=True)), turns, low, high, first, last)
                pieces.append(text)
                edits, state, total = iter(text), end, cost
                continue
            # Insertions before the row, then its own edit.
            for edit in edits:
                made.feed(edit, iter([(role, text)]))
                if edit != "I":
                    break
        if made is not None:
            yield closed()
    kind = found.schema["conv_id"].dataType.simpleString()
    return _stream(dealt, task, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def repair(rows: DataFrame, written, block: int = BLOCK) -> DataFrame:
    """conv_id and the result columns, one row per conversation of `rows` (conv_id, turn, role, text, copy, live)."""
    found = written(stretches(written(faults(rows), "repair-rows"), block), "repair-stretches")
    whole = found.where("seq is null").select("conv_id", "gaps", *_NUMBERS, "cost", "audit", F.col("digest").alias("repaired_sha256"))
    return whole.unionByName(joined(found, written(chained(found), "repair-chain"))).select("conv_id", *_RESULT)


def audited(conversations: DataFrame, written, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the damaged conversations.

    One row per conv_id, the null one included. Null roles and texts are one space. Null turns come first and count for no
    gap; rows that share a turn are taken by role, then by the digest of role and text; rows equal in all are duplicates
    after the first. An empty role has no initial and makes no legal pair. Gaps beyond a long are the largest long. An
    empty table gives no rows; other columns are not read.
    """
    return repair(damaged(conversations.select("conv_id", "turn", "role", "text")), written, block)


# The same programme in SQL: every state is (cost, audit, repaired lines), the least of a list is the cheapest, then the least.
def _edit(state: str, cost: str, edit: str, line: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {state}.r || {line}}} END"


def _insert(state: str, role: str) -> str:
    return _edit(state, str(INSERT), "I", f"chr(10) || '{role}:'")


def _audited_sql() -> str:
    from sampletide.llm.merkle import crc32_sql
    space = r"[\x20\x09-\x0D]"
    drop = [_edit(f"t{s}", str(DELETE), "D", "''") for s in range(4)]
    keep = lambda s, initial: f"CASE WHEN fault < {BLANK} AND initial = '{initial}' THEN {_edit(f't{s}', 'more', 'K', 'line')} END"
    turn = lambda s, role: f"CASE WHEN fault < {BLANK} THEN {_edit(f't{s}', f'more + {REROLE}', 'R', f"chr(10) || '{role}:' || text")} END"
    after = [drop[0], f"list_min([{drop[1]}, {keep(0, 's')}])",
             "list_min([" + ", ".join([drop[2], *(x for s in (0, 1, 3) for x in (keep(s, "u"), turn(s, "user")))]) + "])",
             "list_min([" + ", ".join([drop[3], keep(2, "a"), turn(2, "assistant")]) + "])"]
    empty = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR))"
    return f"""
WITH RECURSIVE drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS draw FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
  CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text), copy) AS i FROM damaged),
told AS (SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS time,
  lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM placed),
marked AS (SELECT *, chr(10) || role || ':' || text AS line, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN {BLANK} WHEN time > 1 THEN {DUPLICATE}
  WHEN NOT regexp_matches(text, '[.!?]{space}*$') THEN {TRUNCATED} ELSE {SOUND} END AS fault FROM told),
states AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS s0, {empty} AS s1, {empty} AS s2, {empty} AS s3
    FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT conv_id, i, {after[0]}, {after[1]}, {after[2]}, {after[3]} FROM
    (SELECT *, list_min([s3, {_insert("t2", "assistant")}]) AS t3 FROM
      (SELECT s.conv_id, m.i, m.fault, m.initial, m.line, m.text, CASE WHEN m.fault = {TRUNCATED} THEN {LEFT_TRUNCATED} ELSE 0 END AS more,
        s0 AS t0, s1 AS t1, list_min([s2, {_insert("s0", "user")}, {_insert("s1", "user")}, {_insert("s3", "user")}]) AS t2, s3
      FROM states s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1))),
ends AS (SELECT conv_id, list_min([s0, s3, {_insert("s2", "assistant")}, {_insert(f"({_insert('s1', 'user')})", "assistant")}]) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM states) WHERE back = 1),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank,
  count(*) FILTER (fault = {DUPLICATE}) AS duplicate, count(*) FILTER (fault = {TRUNCATED}) AS truncated,
  count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


AUDITED_SQL = _audited_sql()
