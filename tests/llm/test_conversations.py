import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from corpuslens.llm import conversations as conv
from corpuslens.llm.queries import QUERIES

GOOD = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def fault_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        rest = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    return faults


def cheapest(rows, faults):
    """Cost, audit and repaired rows by a search over all edits, the cheapest first and of these the least audit."""
    into = {"": {"s", "u"}, "s": {"u"}, "u": {"a"}, "a": {"u"}}
    best = {(0, ""): (0, "", ())}  # rows used, last initial -> cost, audit, repaired

    def offer(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value
            return True
        return False

    def inserted(table):
        moved = True
        while moved:
            moved = False
            for (i, last), (cost, audit, kept) in list(table.items()):
                for name in ("user", "assistant"):
                    if name[0] in into[last]:
                        moved |= offer(table, (i, name[0]), (cost + 2, audit + "I", (*kept, f"{name}:")))

    for i, ((_, role, text), fault) in enumerate(zip(rows, faults)):
        inserted(best)
        after = {}
        for (_, last), (cost, audit, kept) in best.items():
            offer(after, (i + 1, last), (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra = int(fault == "truncated")
            if role[:1] in into[last] and role:
                offer(after, (i + 1, role[0]), (cost + extra, audit + "K", (*kept, f"{role}:{text}")))
            for name in ("user", "assistant"):
                if name[0] in into[last]:
                    offer(after, (i + 1, name[0]), (cost + 2 + extra, audit + "R", (*kept, f"{name}:{text}")))
        best = after
    inserted(best)
    ends = [v for (_, last), v in best.items() if last in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def brute(rows):
    by_id = defaultdict(list)
    for conv_id, turn, role, text in damage(rows):
        by_id[conv_id].append((turn, role, text))
    out = []
    for conv_id in {r[0] for r in rows}:
        mine = sorted(
            by_id[conv_id], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest())
        )
        faults = fault_of(mine)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, kept = cheapest(mine, faults)
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((conv_id, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def frame(spark, rows, parts=3):
    given = [(*r, 1, "x") for r in rows]
    return spark.createDataFrame(
        given, "conv_id LONG, turn LONG, role STRING, text STRING, block INT, audit STRING"
    ).repartition(parts)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_rows(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "super"]
    texts = ["Yes.", "No", "Why?", " ", "", None, "a b c!", "tail \n", "end. \t", "é…", "x" * 50 + "."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.05 else t * rng.choice([1, 1, 1, 2])
            rows.append((c, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


def test_random_conversations(spark):
    rows = some_rows(1, 400, 9) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho.")]
    assert result(conv.report(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_signatures_of_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(conv, "BLOCK", block)
    rows = some_rows(2, 60, 23)
    assert result(conv.report(frame(spark, rows))) == brute(rows)


def test_one_conversation_of_many_rows_and_repeated_rows(spark):
    rows = some_rows(3, 1, 1)
    rows = [(7, t, ("user", "assistant")[t % 2], f"long {t}.") for t in range(3000)]
    rows += [(7, 50, "user", "same.")] * 700 + [(8, None, "user", "same.")] * 5 + [(9, 1, "user", "y " * 200_000)]
    assert result(conv.report(frame(spark, rows, 6))) == brute(rows)


def test_repaired_rows_follow_the_grammar(spark):
    rows = some_rows(4, 80, 7)
    _, _, fixed = conv.repair(conv.damaged(frame(spark, rows)))
    by_id = defaultdict(list)
    for r in fixed.collect():
        by_id[r.conv].append((r.place, r.role, r.edit, r.text))
    assert by_id
    for listed in by_id.values():
        listed.sort()
        assert [p for p, *_ in listed] == list(range(len(listed)))
        assert GOOD.fullmatch("".join(role[0] for _, role, _, _ in listed))
        assert all(text == "" for _, _, edit, text in listed if edit == "I")


def test_automaton_nodes_against_all_edit_strings():
    """Every edit of short signatures, tried out: least cost, then least audit."""
    initials = {"u": "u", "a": "a", "s": "s", "o": "t"}
    for spelt in map("".join, product("suaoUx", repeat=3)):
        rows = [(i, {"u": "user", "a": "assistant", "s": "system", "o": "tool"}[c.lower()] if c != "x" else "user", "") for i, c in enumerate(spelt)]
        faults = ["blank" if c == "x" else "truncated" if c.isupper() else "" for c in spelt]
        node = conv.END
        for letter in reversed(spelt):
            node = conv.extended(letter, node)
        assert (node[0][0], node[1][0]) == cheapest(rows, faults)[:2], spelt
    assert initials


def test_empty_table_and_conversations_without_rows(spark):
    assert conv.report(frame(spark, [(1, 1, "user", "x")]).limit(0)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    assert result(conv.report(frame(spark, [(gone, 1, "user", "x")]))) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_registered_query(spark, folder):
    where = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op13_suffix_automaton_repair"](spark, where)) == brute(rows)
