"""Cheapest repair of the turns of conversations, by a Viterbi search whose survivors coalesce.

A repaired conversation reads `(s?(ua)+)?` in the first letters of its roles. The edits of a row are Keep (0),
Rerole to user or assistant (1) and Delete (2, the only one for a blank row or a duplicate); an empty user
or assistant may be Inserted anywhere (5); a truncated row that stays costs 5 more. Of the cheapest
repairs the one with the ASCII-least string of edit letters is taken.

For each state of the pattern one best path survives. Paths are a tree of backpointers in which each node
counts what refers to it; a node that nothing refers to goes away at once. What lies between the root and the point where
all survivors part is decided, is given out and freed, so only undecided rows are held. A tie is decided by the whole
undecided strings of two paths: two survivors carry what is left of their comparison, so no letter is read twice.
A survivor that another one beats whatever rows follow is dropped, which lets paths meet soon.

Rows of one conversation are sorted by Spark and go through one task as a stream. Held for a conversation
are its undecided rows, a digest of each row (for duplicates) and its edit letters, which are part of the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ROLE_OF = {"u": "user", "a": "assistant"}
#: State after a letter; the pattern ends in START or ASSISTANT.
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Worse[s][t]: from state s no rows cost more than this over what they cost from t, as s can insert or delete what it lacks.
WORSE = ((0, 0, INSERT, 0), (2 * INSERT, 0, INSERT, 2 * INSERT), (INSERT + DELETE, INSERT, 0, INSERT), (DELETE, 0, INSERT, 0))

WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(slots=True, eq=False)
class Node:
    """An edit on a path: its letter, the role and text that come out (None: nothing), and who refers to it."""

    parent: Node | None
    letter: str
    role: str | None
    text: str
    children: list[Node] = field(default_factory=list)
    survivors: int = 0


def _ways(letter: str, fault: str) -> list[tuple[int, int, str, list[tuple[str, str | None]]]]:
    """From state, to state, letters and edits of all that can be done at a row: up to two inserts, then the row's edit."""
    out = []
    for state in STATES:
        here, inserts = state, []
        for _ in range(3):
            before = INSERT * len(inserts)
            out.append((state, here, before + DELETE, [*inserts, ("D", None)]))
            if fault not in ("blank", "duplicate"):
                more = before + (TRUNCATED if fault == "truncated" else 0)
                if (here, letter) in MOVES:
                    out.append((state, MOVES[here, letter], more + KEEP, [*inserts, ("K", "")]))
                for new in "ua":
                    if (here, new) in MOVES:
                        out.append((state, MOVES[here, new], more + REROLE, [*inserts, ("R", ROLE_OF[new])]))
            new = "a" if here == USER else "u"
            inserts = [*inserts, ("I", ROLE_OF[new])]
            here = MOVES[here, new]
    return [(a, b, cost, "".join(x for x, _ in edits), edits) for a, b, cost, edits in out]


#: By first letter of the role and fault. Another letter, or none, fits nowhere.
WAYS = {(letter, fault): _ways(letter, fault) for letter in ("s", "u", "a", "") for fault in ("", "blank", "duplicate", "truncated")}
#: What may be inserted behind the last row: from state, to state, cost, edits.
ENDS = [(a, b, c - DELETE, s[:-1], edits[:-1]) for a, b, c, s, edits in WAYS["", "blank"] if b in (START, ASSISTANT)]


class Repair:
    """One conversation. add() takes its rows in order, finish() ends it; give(letter, role, text) gets each edit once it is decided."""

    def __init__(self, give):
        self.give = give
        self.root = Node(None, "", None, "", survivors=1)
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        #: For two survivors what is left of their letters behind the part that both share.
        self.left: dict[tuple[int, int], tuple[str, str]] = {(START, START): ("", "")}

    def _chosen(self, ways) -> dict[int, tuple]:
        """The cheapest way into each state, of ties that with the least letters."""
        chosen: dict[int, tuple] = {}
        for way in ways:
            source, target, cost, letters, _ = way
            if source not in self.best:
                continue
            total = self.best[source][0] + cost
            have = chosen.get(target)
            if have is not None:
                if total > have[0]:
                    continue
                if total == have[0]:
                    mine, other = self.left[source, have[1][0]]
                    if mine + letters >= other + have[1][3]:
                        continue
            chosen[target] = (total, way)
        return chosen

    def _grow(self, chosen: dict[int, tuple], role: str, text: str) -> None:
        fresh: dict[int, tuple[int, Node]] = {}
        for state, (total, (source, _, _, _, edits)) in chosen.items():
            node = self.best[source][1]
            for letter, new in edits:
                kept = letter in "KR"
                child = Node(node, letter, role if letter == "K" else new, text if kept else "")
                node.children.append(child)
                node = child
            node.survivors += 1
            fresh[state] = (total, node)
        left = {}
        for a, (_, (from_a, _, _, more_a, _)) in chosen.items():
            for b, (_, (from_b, _, _, more_b, _)) in chosen.items():
                x, y = self.left[from_a, from_b]
                x, y = x + more_a, y + more_b
                same = 0
                while same < min(len(x), len(y)) and x[same] == y[same]:
                    same += 1
                x, y = x[same:], y[same:]
                # Two letters that differ decide for good.
                left[a, b] = (x[:1], y[:1]) if x and y else (x, y)
        before, self.best, self.left = self.best, fresh, left
        for _, node in before.values():
            node.survivors -= 1
            self._free(node)

    def _free(self, node: Node) -> None:
        while node.parent is not None and not node.survivors and not node.children:
            node.parent.children.remove(node)
            node = node.parent

    def _give_decided(self) -> None:
        while not self.root.survivors and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.give(self.root.letter, self.root.role, self.root.text)

    def add(self, role: str, text: str, fault: str) -> None:
        letter = role[:1] if role[:1] in ("s", "u", "a") else ""
        self._grow(self._chosen(WAYS[letter, fault]), role, text)
        costs = {state: cost for state, (cost, _) in self.best.items()}
        for t in [t for t in costs if any(costs[s] + WORSE[s][t] < costs[t] for s in costs)]:
            node = self.best.pop(t)[1]
            node.survivors -= 1
            self._free(node)
        self._give_decided()

    def finish(self) -> int:
        """The cost of the whole repair."""
        ends = self._chosen(ENDS)
        total, state = min((ends[s][0], s) for s in ends)
        if len(ends) == 2 and ends[START][0] == ends[ASSISTANT][0]:
            letters = {s: (ends[s][1][0], ends[s][1][3]) for s in ends}
            mine, other = self.left[letters[START][0], letters[ASSISTANT][0]]
            state = START if mine + letters[START][1] < other + letters[ASSISTANT][1] else ASSISTANT
        self._grow({state: ends[state]}, "", "")
        self._give_decided()
        return total


def repaired(rows: Iterator[tuple[int | None, str, str]]) -> dict:
    """Faults, cost, edit letters and digest of one conversation's rows (turn, role, text), given in order."""
    out = {"n_rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    audit: list[str] = []
    digest = hashlib.sha256()
    first = True

    def give(letter: str, role: str | None, text: str) -> None:
        nonlocal first
        audit.append(letter)
        if role is not None:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False

    search = Repair(give)
    seen: set[bytes] = set()
    turns = [None, None, 0]
    last_turn = last_letter = None
    for turn, role, text in rows:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        end = len(text.rstrip(" \t\n\v\f\r"))
        fault = "blank" if end == 0 else "duplicate" if key in seen else "" if text[end - 1] in ".!?" else "truncated"
        seen.add(key)
        if fault:
            out[fault] += 1
        letter = role[:1]
        if out["n_rows"] and last_letter + letter not in LEGAL:
            out["illegal"] += 1
        last_letter = letter
        out["n_rows"] += 1
        if turn is not None and (last_turn is None or turn != last_turn):
            turns = [turn if turns[2] == 0 else turns[0], turn, turns[2] + 1]
            last_turn = turn
        search.add(role, text, fault)
    out["cost"] = search.finish()
    out["gaps"] = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
    out["audit"] = "".join(audit)
    out["repaired_sha256"] = digest.hexdigest()
    return out


SCHEMA = "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Each conversation's rows as a stream, from batches that are sorted by conversation."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
    ahead = next(rows, None)

    def one(conv):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            row = ahead
            ahead = next(rows, None)
            yield row[1:]

    while ahead is not None:
        yield ahead[0], one(ahead[0])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in NAMES])
    done: list[dict] = []
    for conv, rows in _conversations(batches):
        done.append({"conv_id": conv, **repaired(rows)})
        if len(done) == 1024:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    yield pa.RecordBatch.from_pylist(done, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: its faults, the cost and the letters of its cheapest repair, and the repaired text's digest.

    Rows are taken by turn, nulls first, then by role and text. A null role or text is one space; rows of
    null conv_id are one conversation. A role that does not begin with s, u or a cannot be kept. Repeated rows are
    duplicates. Without rows there is no conversation. Other columns are not looked at.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(_searched, SCHEMA)


def edits_of(rows: list[tuple[int | None, str, str]]) -> list[tuple[str, str | None, str]]:
    """The edits themselves of one conversation: letter, role and text that come out (role None: deleted)."""
    out: list[tuple[str, str | None, str]] = []
    search = Repair(lambda *edit: out.append(edit))
    seen: set[tuple[str, str]] = set()
    for _, role, text in rows:
        end = len(text.rstrip(" \t\n\v\f\r"))
        search.add(role, text, "blank" if end == 0 else "duplicate" if (role, text) in seen else "" if text[end - 1] in ".!?" else "truncated")
        seen.add((role, text))
    search.finish()
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32 of `conv_id:turn`, modulo 20: 0 dropped, 1 emptied, 2 without `[.!?]`, 3 repeated, 4 of role user."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
