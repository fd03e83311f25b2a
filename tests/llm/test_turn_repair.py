"""Repair of conversations: cells against all edits, blocks against whole conversations, odd rows."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from steadycare.llm import queries, turn_repair

SOUND = re.compile(r"(s?(ua)+)?")


def all_edits(rows):
    """Least (cost, audit) over every choice of edits of rows (initial, go, truncated), with up to two inserts in a place."""
    best = None
    inserts = ["", "I", "II"]
    for gaps in product(inserts, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 3:
            continue
        for letters in product("KRD", repeat=len(rows)):
            if any(go and letter != "D" for (_, go, _), letter in zip(rows, letters)):
                continue
            audit = "".join(g + x for g, x in zip(gaps, [*letters, ""]))
            cost = 5 * sum(map(len, gaps)) + sum({"K": 0, "R": 1, "D": 2}[x] for x in letters)
            cost += 5 * sum(t for (_, _, t), x in zip(rows, letters) if x != "D")
            if best is not None and (cost, audit) >= best:
                continue
            initials = [""]
            for i, gap in enumerate(gaps):
                initials = [s + a for s in initials for a in map("".join, product("ua", repeat=len(gap)))]
                if i < len(rows) and letters[i] == "K":
                    initials = [s + rows[i][0] for s in initials]
                elif i < len(rows) and letters[i] == "R":
                    initials = [s + a for s in initials for a in "ua"]
            if any(SOUND.fullmatch(s) for s in initials):
                best = (cost, audit)
    return best


def leaf(row):
    return turn_repair._deleted(1) if row[1] else turn_repair.row_cells(row[0], False, row[2])


@pytest.mark.parametrize("seed", range(40))
def test_cells_hold_the_least_cost_and_audit(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("suuaa x"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(0, 5))]
    leaves = [leaf(r) for r in rows]
    cost, parts = turn_repair.combine_blocks([turn_repair.parse(leaves)] if leaves else [])
    assert (cost, "".join(parts)) == all_edits(rows) or not rows
    for block in (1, 2, 3):
        blocks = [turn_repair.parse(leaves[i : i + block]) for i in range(0, len(leaves), block)]
        again, parts = turn_repair.combine_blocks(blocks)
        assert not rows or (again, "".join(parts)) == all_edits(rows)


def test_any_split_of_a_span_gives_the_same_cell():
    rng = random.Random(9)
    leaves = [turn_repair.row_cells(rng.choice("sua"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(9)]
    cells = {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for length in range(2, 10):
        for i in range(10 - length):
            found = [turn_repair.combine(cells[i, k], cells[k, i + length]) for k in range(i + 1, i + length)]
            assert all(f == found[0] for f in found)
            cells[i, i + length] = found[0]
    assert cells[0, 9] == turn_repair.parse(leaves)


def plain(rows):
    """The report of one conversation: rows (turn, role, text) as they are after damage."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    rows = sorted(rows, key=key)
    seen, blank, duplicate, truncated, parsed = set(), 0, 0, 0, []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        is_blank, is_duplicate = not bare, bool(bare) and (role, text) in seen
        is_truncated = not is_blank and not is_duplicate and bare[-1] not in ".!?"
        seen.add((role, text))
        blank, duplicate, truncated = blank + is_blank, duplicate + is_duplicate, truncated + is_truncated
        parsed.append((role[:1], is_blank or is_duplicate, is_truncated))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(parsed, parsed[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    states = {0: (0, "", ())}  # state -> cost, audit, repaired turns
    steps = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def insert():
        for _ in range(2):
            for initial, role in (("u", "user"), ("a", "assistant")):
                for p, q in steps[initial].items():
                    if p in states:
                        cost, audit, out = states[p]
                        offer = (cost + 5, audit + "I", (*out, (role, "")))
                        if q not in states or offer[:2] < states[q][:2]:
                            states[q] = offer

    for (initial, go, cut), (_, role, text) in zip(parsed, rows):
        insert()
        after = {}
        for p, (cost, audit, out) in states.items():
            offers = [(p, cost + 2, "D", out)]
            if not go:
                if p in steps.get(initial, {}):
                    offers.append((steps[initial][p], cost + 5 * cut, "K", (*out, (role, text))))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if p in steps[to]:
                        offers.append((steps[to][p], cost + 1 + 5 * cut, "R", (*out, (name, text))))
            for q, c, letter, o in offers:
                if q not in after or (c, audit + letter) < after[q][:2]:
                    after[q] = (c, audit + letter, o)
        states = after
    insert()
    cost, audit, out = min(states[q] for q in (0, 3) if q in states)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        chance = zlib.crc32(key.encode()) % 20
        if chance:
            text = "" if chance == 1 else re.sub("[.!?]", "", text) if chance == 2 else text
            out += [(conv, turn, "user" if chance == 4 else role, text)] * (2 if chance == 3 else 1)
    return out


def reports(rows):
    return {
        conv: plain([r[1:] for r in damage(rows) if r[0] == conv])
        for conv in {r[0] for r in rows}
    }


def collected(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


TEXTS = [None, "", " \n", "a.", "b", "b.", "Long? ", "x\u0085", "end!\t", "é", " "]


@pytest.mark.parametrize("block", [2, 1024])
def test_reports_of_odd_rows(spark, block):
    rng = random.Random(block)
    rows = [
        (rng.choice([None, *range(12)]), rng.choice([None, *range(9)]), rng.choice([None, "", "system", "user", "assistant", "tool"]), rng.choice(TEXTS))
        for _ in range(400)
    ]
    rows += [(50, turn, "user" if turn % 3 else "assistant", f"{rng.randrange(40)}.") for turn in range(300)]  # a hot conversation
    rows += [(51, 7, "user", "same.")] * 50 + [(52, 0, "user", "only")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, digest string").repartition(4)
    got = turn_repair.repair_report(turn_repair.damaged(df), df, block)
    assert collected(got) == reports(rows)


def test_repaired_turns_are_sound_and_in_order(spark):
    rows = [(c, t, r, f"{c} {t}.") for c in range(20) for t, r in enumerate(random.Random(c).choices(["system", "user", "assistant"], k=7))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turn_repair.repaired_turns(df, turn_repair.find_repairs(df, 3)).collect()
    for c in range(20):
        mine = [r for r in turns if r.conv_id == c]
        assert [r.place for r in mine] == list(range(len(mine)))
        assert SOUND.fullmatch("".join(r.role[0] for r in mine))
        assert all((r.text == "") == (r.edit == "I") for r in mine)


def test_an_empty_table_gives_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair_report(turn_repair.damaged(df), df).count() == 0


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert collected(queries.op12_turn_repair(spark, folder)) == reports(rows)
