"""Repairs against all edits tried out, memory of undecided rows, odd rows."""

import hashlib
import itertools
import random
import re

import pytest

from vecsink.llm.conversation_repair import Repair, damaged, edits_of, repair

PATTERN = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cost and letters of the best of all edits, with up to two inserts at each place."""
    choices = []
    for (_, role, _), fault in zip(rows, faults_of(rows), strict=True):
        ways = [("D", "", 2)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            ways += [("K", role[:1] or "?", more), ("R", "u", 1 + more), ("R", "a", 1 + more)]
        choices.append(ways)
    places, best = [("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au")], None
    for picked in itertools.product(*choices):
        for added in itertools.product(places, repeat=len(rows) + 1):
            cost = sum(c for _, _, c in picked) + 5 * sum(len(a) for a, _ in added)
            if best is not None and cost > best[0]:
                continue
            if PATTERN.fullmatch(added[0][1] + "".join(r + a for (_, r, _), (_, a) in zip(picked, added[1:], strict=True))):
                letters = added[0][0] + "".join(x + a for (x, _, _), (a, _) in zip(picked, added[1:], strict=True))
                best = min(best or (cost, letters), (cost, letters))
    return best


def test_repairs_equal_all_edits_tried():
    draw = random.Random(5)
    for _ in range(150):
        rows = [(i, draw.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), draw.choice(["a.", "b.", "c", "", "d!", " e? "])) for i in range(draw.randrange(5))]
        cost, letters = plain_repair(rows)
        given = []
        search = Repair(lambda *edit, to=given: to.append(edit))
        for (_, role, text), fault in zip(rows, faults_of(rows), strict=True):
            search.add(role, text, fault)
        assert (search.finish(), "".join(x for x, _, _ in given)) == (cost, letters)
        assert given == edits_of(rows)
        roles = [r for _, r, _ in given if r is not None]
        assert PATTERN.fullmatch("".join(r[:1] for r in roles))


def nodes_below(node):
    return 1 + sum(nodes_below(child) for child in node.children)


def test_decided_rows_are_freed():
    draw, most = random.Random(2), 0
    search = Repair(lambda *edit: None)
    for i in range(20_000):
        search.add(draw.choice(["user", "assistant"]), f"{i}.", draw.choice(["", "", "", "truncated", "blank"]))
        if i % 50 == 0:
            most = max(most, nodes_below(search.root))
    assert most < 250


def test_ties_that_stay_open():
    """Roles that fit nowhere: one row too many is deleted, the first one; nothing is decided before the end."""
    given = []
    search = Repair(lambda letter, role, text: given.append(letter))
    for i in range(3001):
        search.add("tool", f"{i}.", "")
    assert not given
    assert search.finish() == 3002 and "".join(given) == "D" + "R" * 3000


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
        (2, None, None, None), (2, 3, "user", "cut"), (2, 3, "user", "cut"), (2, 9, "assistant", "So."),
        (None, 0, "user", "a."), (None, None, "system", "s."), (None, 1, "assistant", "b."),
        (3, 0, "", "x."), (3, 1, "assistant", "no question?"),
        (4, None, None, None), (4, None, "user", " \t\n"),
        (5, 0, "user", "long. " * 200_000), (5, 1, "assistant", "ok!"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS audit", "1 AS cost", "2 AS n_rows")
    found = {r.conv_id: r for r in repair(frame).collect()}
    told = {c: (r.n_rows, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for c, r in found.items()}
    assert told == {
        1: (2, 0, 0, 0, 0, 0, 0, "KK"),
        2: (4, 5, 1, 1, 1, 2, 8, "DDDD"),
        None: (3, 0, 0, 0, 0, 0, 0, "KKK"),
        3: (2, 0, 0, 0, 0, 1, 1, "RK"),
        4: (2, 0, 2, 0, 0, 1, 4, "DD"),
        5: (2, 0, 0, 0, 0, 0, 0, "KK"),
    }
    assert found[None].repaired_sha256 == hashlib.sha256(b"system:s.\nuser:a.\nassistant:b.").hexdigest()
    assert found[3].repaired_sha256 == hashlib.sha256(b"user:x.\nassistant:no question?").hexdigest()
    assert found[4].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair(frame.where("false")).collect() == []


@pytest.mark.parametrize("kind", range(6))
def test_damage(spark, kind):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in (0, None)]
    mine = [r for r in rows if min(5, zlib.crc32(f"{r[0]}:{' ' if r[1] is None else r[1]}".encode()) % 20) == kind]
    assert mine
    found = sorted(tuple(r) for r in damaged(spark.createDataFrame(mine, "conv_id long, turn long, role string, text string")).fillna(-1).collect())
    change = {1: lambda r: (*r[:3], ""), 2: lambda r: (*r[:3], "One Two Three"), 4: lambda r: (*r[:2], "user", r[3])}.get(kind, lambda r: r)
    want = sorted(tuple(-1 if v is None else v for v in change(r)) for r in mine for _ in range({0: 0, 3: 2}.get(kind, 1)))
    assert found == want


def test_conversations_that_are_dropped_whole(spark, tmp_path):
    from vecsink.llm.queries import QUERIES

    spark.createDataFrame([(c, None if c is None or c % 2 else 0, "user", "x.") for c in [*range(40), None]], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert found.keys() == {*range(40), None}
    empty = hashlib.sha256(b"").hexdigest()
    gone = [r for r in found.values() if r.audit == ""]
    assert gone and all((r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.repaired_sha256) == (0, 0, 0, 0, 0, 0, empty) for r in gone)
