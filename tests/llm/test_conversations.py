import hashlib
import itertools
import random
import re
import zlib

import pytest

from rosterloom.llm import conversations as c


def brute_edits(initials, faults):
    """Every sequence of edits with at most two insertions at a place, judged by its roles alone."""
    best = None
    per_row = [("D",) if f in "bd" else ("D", "K", "Ru", "Ra") for f in faults]
    runs = ["", "u", "a", "ua", "au", "uu", "aa"]
    for edits in itertools.product(*per_row):
        for extra in itertools.product(runs, repeat=len(initials) + 1):
            roles, audit, cost = extra[0], "I" * len(extra[0]), 2 * len("".join(extra))
            for k, edit in enumerate(edits):
                audit += edit[0]
                if edit != "D":
                    roles += initials[k] if edit == "K" else edit[1]
                cost += {"D": 3, "K": 0, "R": 2}[edit[0]] + (edit != "D" and faults[k] == "t")
                roles, audit = roles + extra[k + 1], audit + "I" * len(extra[k + 1])
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def shortest_edits(initials, faults):
    """All states of one row after the other, each with the least (cost, audit)."""
    now = {"": (0, "")}  # by what the roles so far end in
    turn = lambda s: "a" if s == "u" else "u"

    def with_insertions(table):
        for _ in range(3):
            for s, (cost, audit) in list(table.items()):
                new = (cost + 2, audit + "I")
                table[turn(s)] = min(table.get(turn(s), new), new)
        return table

    for initial, fault in zip(initials, faults, strict=True):
        then = {}
        for s, (cost, audit) in with_insertions(now).items():
            ways = [(s, 3, "D")]
            if fault not in "bd":
                ways.append((turn(s), 2 + (fault == "t"), "R"))
                if s + initial in ("s", "u", "su", "ua", "au"):
                    ways.append((initial, int(fault == "t"), "K"))
            for s2, more, edit in ways:
                new = (cost + more, audit + edit)
                then[s2] = min(then.get(s2, new), new)
        now = then
    now = with_insertions(now)
    return min(v for s, v in now.items() if s in ("", "a"))


def test_search_finds_what_all_edits_find():
    for n in range(4):
        for initials in itertools.product("sua ", repeat=n):
            faults = "".join(random.Random(repr(initials)).choices("  tbd", k=n))
            text = "".join(initials)
            assert c.cheapest_edits(text, faults) == brute_edits(text, faults) == shortest_edits(text, faults)


@pytest.mark.parametrize("n", [7, 20, 47, 48, 49, 150])
@pytest.mark.parametrize("roles", ["uuuaaasx", "ua", "u", "sa", "x"])
def test_longer_conversations_and_segments(n, roles):
    random_ = random.Random(n)
    for _ in range(12):
        initials = "".join(random_.choices(roles, k=n))
        faults = "".join(random_.choices("    ttbd", k=n))
        assert c.cheapest_edits(initials, faults) == shortest_edits(initials, faults)


def brute_conversation(conv_id, rows):
    """The contract, row by row, for rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = "", set()
    for _, role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        faults += "b" if not last else "d" if (role, text) in seen else " " if last in ".!?" else "t"
        seen.add((role, text))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit = shortest_edits([r[:1] or "?" for _, r, _ in rows], faults)
    out, k, s = [], 0, ""
    for edit in audit:
        if edit == "I":
            s = "a" if s == "u" else "u"
            out.append({"a": "assistant:", "u": "user:"}[s])
            continue
        _, role, text = rows[k]
        k += 1
        if edit == "K":
            s = role[:1]
            out.append(f"{role}:{text}")
        elif edit == "R":
            s = "a" if s == "u" else "u"
            out.append({"a": "assistant:", "u": "user:"}[s] + text)
    count = [faults.count(f) for f in "bdt"]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (conv_id, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_damage(table):
    out = {}
    for conv_id, turn, role, text in table:
        name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        fate = zlib.crc32(name.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out.setdefault(conv_id, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1))
    return sorted((brute_conversation(k, rows) for k, rows in out.items()), key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_repair_after_damage_agrees_with_brute_force(spark):
    random_ = random.Random(2)
    texts = ["", " ", "\t\n", "Well.", "Well", "Yes! ", "no?\n", "a. b", " ", "x" * 5000 + ".", None, "é漢。", "same"]
    table = []
    for conv_id in [*range(300), None]:
        for turn in range(random_.randrange(1, 12)):
            role = random_.choice(["user", "assistant", "user", "assistant", "system", "", "tool", None, "User"])
            table.append((conv_id, None if random_.random() < 0.01 else turn * random_.choice([1, 1, 1, 3]), role, random_.choice(texts)))
    # one row for each conversation and turn: the order of others is the library's own
    table = list({(r[0], r[1]): r for r in table}.values())
    table += [(2**62 + k, 2**60 + 3 * k, "user", "Far out.") for k in range(9)]  # beside null ids and turns
    table += [(900 + k, 0, "user", "Only one.") for k in range(60)]
    table += [(2000, t, "user" if t % 3 else "assistant", f"Turn {t}.") for t in range(700)]
    random_.shuffle(table)
    df = spark.createDataFrame([(*r, "clash", 1) for r in table], "conv_id long, turn long, role string, text string, audit string, x int")
    want = brute_damage(table)
    assert got(c.repaired_after_damage(df.repartition(5))) == want
    assert any(r[7] == "" for r in want)  # some conversation lost all its rows
    assert c.repaired_after_damage(df.limit(0)).count() == 0
    assert c.repaired(df.limit(0)).count() == 0


def test_repeated_rows_and_rows_of_one_turn(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, None, "system", "Be kind.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute_conversation(1, [(t, r, x) for _, t, r, x in rows])
    assert want[7] == "KKDDK" and want[3] == 2
    assert got(c.repaired(df)) == [want]
    same_turn = spark.createDataFrame([(5, 1, r, "Ok.") for r in ("user", "assistant", "user")], "conv_id int, turn int, role string, text string")
    assert got(c.repaired(same_turn.repartition(3))) == got(c.repaired(same_turn)) == [brute_conversation(5, [(1, r, "Ok.") for r in ("assistant", "user", "user")])]


def test_query_agrees_with_brute_force(spark):
    from rosterloom.llm.queries import QUERIES

    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.001")) == brute_damage(table)
