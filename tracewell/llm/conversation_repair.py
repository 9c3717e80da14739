"""Cheapest repair of a conversation's structure: a Viterbi search that puts out edits while it goes.

A conversation should read as roles whose initials are `(s?(ua)+)?`.  Four states say how far that has come: nothing yet,
after a system turn, after a user turn, after an assistant turn.  A row is kept, given another role or deleted, and
empty turns may be inserted anywhere; each state keeps its cheapest way, and of equally cheap ways the one whose edits,
written as initials, are least as text.

Ways are paths in a tree of backpointers whose nodes count what hangs on them: a node nobody needs goes, and as soon as
all states' ways share a beginning, its edits are put out and forgotten.  So memory holds the part that is still
undecided, not the conversation.  Tied ways are compared over their whole undecided parts: the order of the survivors'
texts is kept as a rank from row to row (after a row no survivor's text can be the beginning of another's, they all end
in that row's edit), so a comparison takes one step however long the parts are.  A state that another one can
replace at less than the difference of their costs is dropped, which is what lets ways meet.

A conversation is put in order by Spark and streamed through one task, row by row; which rows repeat earlier ones is
found by a window beforehand, so that the task keeps no set of what it has seen.

Defined cases: a null role or text is one space, and so are a null conversation or turn in the text that damage is drawn from.
Rows without a conv_id are one conversation whose id is null.  Null turns come first; rows with equal turns are ordered by
role and text, so repeated rows stand side by side.  A role's first character counts, whatever the role; an empty role
has none and fits nowhere.  A conversation without rows has an empty repair that costs nothing.  Texts and conversations may
be of any length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.llm import common
from tracewell.llm.registry import query

WHITE = "\x20\t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}

START, SYSTEM, USER, ASSISTANT = range(4)
# The state that a user or assistant turn, inserted or by a new role, leads to, and that turn's role.
TURN = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
FINAL = (START, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# INSTEAD[x][y]: what it costs at most to go on from x in place of y, whatever comes.
INSTEAD = ((0, 0, 3, 0), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))


class Node:
    """One edit of a way; `refs` counts the survivors and edits that hang on it."""

    __slots__ = ("up", "edit", "refs", "next")

    def __init__(self, up: Node | None, edit: tuple[str, str | None, str | None] | None):
        self.up, self.edit, self.refs, self.next = up, edit, 0, []
        if up is not None:
            up.refs += 1
            up.next.append(self)


def _release(node: Node) -> None:
    node.refs -= 1
    while not node.refs and node.up is not None:
        up = node.up
        up.next.remove(node)
        up.refs -= 1
        node = up


class Search:
    """The cheapest repair of rows that come one at a time; edits are (initial, role, text), a deletion's row included."""

    def __init__(self) -> None:
        self.root = Node(None, None)
        # Per state: cost, rank of the text up to the last row, how many insertions after it, node.
        self.ways: dict[int, tuple[int, int, int, Node]] = {}
        self._survive({START: (0, 0, self.root)})

    def row(self, role: str, text: str, lost: bool, truncated: bool) -> Iterator[tuple[str, str | None, str | None]]:
        """Take a row; `lost` ones must go.  Gives the edits that are decided now."""
        best: dict[int, tuple] = {}

        def offer(to: int, cost: int, rank: int, text_: str, node: Node, edit: tuple) -> None:
            if to not in best or (cost, rank, text_) < best[to][:3]:
                best[to] = (cost, rank, text_, node, edit)

        held = TRUNCATED if truncated else 0
        for state, (cost, rank, inserted, node) in self.ways.items():
            before = "I" * inserted
            offer(state, cost + DELETE, rank, before + "D", node, ("D", role, text))
            if lost:
                continue
            kept = KEPT.get((state, role[:1]))
            if kept is not None:
                offer(kept, cost + held, rank, before + "K", node, ("K", role, text))
            to, given = TURN[state]
            offer(to, cost + held + REROLE, rank, before + "R", node, ("R", given, text))
        ranks = {key: n for n, key in enumerate(sorted(b[1:3] for b in best.values()))}
        old = [way[3] for way in self.ways.values()]
        self._survive({to: (b[0], ranks[b[1:3]], Node(b[3], b[4])) for to, b in best.items()})
        for node in old:
            _release(node)
        return self._decided()

    def _survive(self, cores: dict[int, tuple[int, int, Node]]) -> None:
        """The ways after a row, insertions behind it included, without states that another one can replace."""
        ways = {s: (cost, rank, 0, s) for s, (cost, rank, _) in cores.items()}
        for state in (START, SYSTEM, ASSISTANT, USER, ASSISTANT):
            if state not in ways:
                continue
            cost, rank, inserted, core = ways[state]
            to, more = TURN[state][0], (cost + INSERT, rank, inserted + 1, core)
            if to not in ways or more[:3] < ways[to][:3]:
                ways[to] = more
        left = {
            s: w for s, w in ways.items() if not any(other[0] + INSTEAD[o][s] < w[0] for o, other in ways.items())
        }
        self.ways = {}
        for node in (c[2] for c in cores.values()):
            node.refs += 1
        for state, (cost, rank, inserted, core) in left.items():
            node, at = cores[core][2], core
            for _ in range(inserted):
                at, role = TURN[at]
                node = self._inserted(node, role)
            node.refs += 1
            self.ways[state] = (cost, rank, inserted, node)
        for node in (c[2] for c in cores.values()):
            _release(node)

    @staticmethod
    def _inserted(node: Node, role: str) -> Node:
        """The insertion behind `node`; two ways through it share it."""
        return next((n for n in node.next if n.edit[0] == "I"), None) or Node(node, ("I", role, ""))

    def _decided(self) -> Iterator[tuple[str, str | None, str | None]]:
        while self.root.refs == 1 and self.root.next:
            self.root = self.root.next[0]
            self.root.up = None
            yield self.root.edit

    def undecided(self) -> int:
        """How many edits are held back."""
        todo, n = list(self.root.next), 0
        while todo:
            node = todo.pop()
            todo += node.next
            n += 1
        return n

    def end(self) -> tuple[int, list[tuple[str, str | None, str | None]]]:
        """The cost of the whole repair and the edits not yet put out."""
        cost, _, _, node = min((self.ways[s] for s in FINAL if s in self.ways), key=lambda w: w[:3])
        rest = []
        while node is not self.root:
            rest.append(node.edit)
            node = node.up
        return cost, rest[::-1]


@dataclass
class Conversation:
    """One pass over a conversation's rows in order."""

    conv_id: object
    search: Search = field(default_factory=Search)
    step: int = 0
    rows: int = 0
    last: str | None = None  # the role before
    turn: int | None = None  # the turn before, and the first one
    first: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def row(self, turn: int | None, role: str, text: str, repeats: bool) -> Iterator[tuple]:
        if self.last is not None and self.last[:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        end = text.rstrip(WHITE)[-1:]
        blank, truncated = not end, False
        if blank:
            self.blank += 1
        elif repeats:
            self.duplicate += 1
        elif end not in STOPS:
            truncated = True
            self.truncated += 1
        return self.search.row(role, text, blank or repeats, truncated)

    def gaps(self) -> int:
        return 0 if self.turn is None else self.turn - self.first + 1 - self.turns


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults drawn from a checksum of conversation and turn; `lost` marks rows that are dropped.

    A conversation of which nothing is left is still seen by its lost rows.
    """
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    drawn = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(named.cast("binary")) % 20).alias("_hit"))
    hit = F.col("_hit")
    return drawn.select(
        "conv_id",
        "turn",
        F.when(hit == 0, "").when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit.isin(0, 1), "").when(hit == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        (hit == 0).alias("lost"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Each conversation's rows side by side in one partition, by turn; `repeats` marks role and text seen earlier.

    One shuffle, by conversation; the window and the final order only sort within it.
    """
    turn = F.col("turn").asc_nulls_first()
    seen = Window.partitionBy("conv_id", "lost", "role", "text").orderBy(turn)
    marked = rows.repartition("conv_id").withColumn("repeats", F.row_number().over(seen) > 1)
    return marked.sortWithinPartitions("conv_id", turn, "role", "text", "repeats").select("conv_id", "turn", "role", "text", "lost", "repeats")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, Iterator[tuple], bool]]:
    """Per row: its conversation, the edits that it decides, and whether it is the first of the conversation."""
    now: Conversation | None = None
    for whole in batches:
        for batch in common.pieces_of(whole, "text"):
            for conv_id, turn, role, text, lost, repeats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = now is None or now.conv_id != conv_id
                if first:
                    now = Conversation(conv_id)
                yield now, iter(()) if lost else now.row(turn, role, text, repeats), first


BATCH_ROWS, BATCH_TEXT = 10_000, 16 << 20


def _streamed(rows: DataFrame, columns: str, each: Callable[[Iterator], Iterator[tuple]]) -> DataFrame:
    """What `each` makes of the conversations of a partition, in batches bounded by rows and text."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = [c.split()[0] for c in columns.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    made = [types[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv_id").type
                yield batch

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (id_type, *made), strict=True)], ["conv_id", *names])

        out, held = [], 0
        for row in each(_conversations(noted())):
            out.append(row)
            held += len(row[-1])
            if len(out) >= BATCH_ROWS or held > BATCH_TEXT:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()

    return in_order(rows).mapInArrow(run, f"conv_id {kind}, {columns}")


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of each conversation's cheapest repair: conv_id, step, edit (initial), role, text.

    `rows` have conv_id, turn, role, text and `lost`.  Edits without deletions, by step, are the repaired conversation; a
    deletion has the role and text that went.
    """

    def each(conversations: Iterator) -> Iterator[tuple]:
        last = None
        for now, edits, first in conversations:
            if first:
                yield from _numbered(last, None)
                last = now
            yield from _numbered(now, edits)
        yield from _numbered(last, None)

    return _streamed(rows, "step long, edit string, role string, text string", each)


def _numbered(who: Conversation | None, edits: Iterator[tuple] | None) -> Iterator[tuple]:
    """The edits with their steps; without any given, those that are left at the end."""
    if who is None:
        return
    for edit in who.search.end()[1] if edits is None else edits:
        yield who.conv_id, who.step, *edit
        who.step += 1


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation: its faults, what the repair costs, its edits' initials, and a digest of the repaired turns."""

    def each(conversations: Iterator) -> Iterator[tuple]:
        last, audit, digest = None, [], hashlib.sha256()

        def take(edits) -> None:
            for letter, role, text in edits:
                audit.append(letter)
                if letter != "D":
                    digest.update((f"\n{role}:{text}" if last.step else f"{role}:{text}").encode())
                    last.step += 1

        def ended() -> tuple:
            cost, rest = last.search.end()
            take(rest)
            counts = (last.gaps(), last.blank, last.duplicate, last.truncated, last.illegal, cost)
            return last.conv_id, *counts, digest.hexdigest(), "".join(audit)

        for now, edits, first in conversations:
            if first:
                if last is not None:
                    yield ended()
                last, audit, digest = now, [], hashlib.sha256()
            take(edits)
        if last is not None:
            yield ended()

    counts = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return _streamed(rows, f"{counts}, repaired_sha256 string, audit string", each)


# The search as a recursion that keeps every state's whole text: what the operator does without keeping it.
SQL = """
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), drawn AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS hit
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
           CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM drawn, unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copies(c) WHERE hit <> 0
), ended_by AS (
    SELECT *, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM damaged
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           left(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 1) || left(role, 1) AS pair
    FROM ended_by
), rows_ AS (
    SELECT conv_id, turn, role, text, i, pair, last = '' AS blank, last NOT IN ('.', '!', '?') AS cut,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
    FROM numbered
), faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
           count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM rows_ GROUP BY conv_id
), moves(state, ins, added, mid) AS (
    VALUES ('0', '', [], '0'), ('0', 'I', ['user:'], 'u'), ('0', 'II', ['user:', 'assistant:'], 'a'),
           ('s', '', [], 's'), ('s', 'I', ['user:'], 'u'), ('s', 'II', ['user:', 'assistant:'], 'a'),
           ('u', '', [], 'u'), ('u', 'I', ['assistant:'], 'a'), ('a', '', [], 'a'), ('a', 'I', ['user:'], 'u')
), edits(mid, letter, initial, given, price, state) AS (
    VALUES ('0', 'D', NULL, NULL, 4, '0'), ('s', 'D', NULL, NULL, 4, 's'), ('u', 'D', NULL, NULL, 4, 'u'), ('a', 'D', NULL, NULL, 4, 'a'),
           ('0', 'K', 's', NULL, 0, 's'), ('0', 'K', 'u', NULL, 0, 'u'), ('s', 'K', 'u', NULL, 0, 'u'), ('a', 'K', 'u', NULL, 0, 'u'),
           ('u', 'K', 'a', NULL, 0, 'a'), ('0', 'R', NULL, 'user', 3, 'u'), ('s', 'R', NULL, 'user', 3, 'u'), ('a', 'R', NULL, 'user', 3, 'u'),
           ('u', 'R', NULL, 'assistant', 3, 'a')
), ways AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS turns FROM faults
    UNION ALL
    SELECT conv_id, i, state, cost, audit, turns FROM (
        SELECT w.conv_id, r.i, e.state,
               w.cost + 3 * length(m.ins) + e.price + CASE WHEN e.letter <> 'D' AND r.cut THEN 3 ELSE 0 END AS cost,
               w.audit || m.ins || e.letter AS audit,
               list_concat(w.turns, m.added, CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.given, r.role) || ':' || r.text] END) AS turns
        FROM ways w JOIN moves m ON m.state = w.state
        JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        JOIN edits e ON e.mid = m.mid AND (e.letter = 'D' OR NOT (r.blank OR r.again)) AND (e.initial IS NULL OR e.initial = left(r.role, 1))
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), ended AS (
    SELECT w.conv_id, w.cost + 3 * length(m.ins) AS cost, w.audit || m.ins AS audit, list_concat(w.turns, m.added) AS turns
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
    JOIN moves m ON m.state = w.state AND m.mid IN ('0', 'a')
    QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 3 * length(m.ins), w.audit || m.ins) = 1
)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
       coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op12_conversation_repair", SQL)
def op12_conversation_repair(spark, folder):
    return repair_report(damaged(common.read(spark, folder, "conversations")))
