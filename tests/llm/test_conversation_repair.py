"""Conversation repair against an exhaustive search, and the registered query against a plain version of its contract."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sluiceway.llm import conversation_repair as C
from sluiceway.llm.queries import corpus_queries
from tests.llm.conftest import CONVERSATIONS

SF_DIR = "/root/testdata/sf0.01"


def faults_of(rows):
    """blank, duplicate, truncated or None for each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, edits and repaired lines by the whole table of suffixes with their texts, least cost first and then least text."""
    faults = faults_of(rows)
    best = {"": (0, "", ()), "s": (10, "II", ("user:", "assistant:")), "u": (5, "I", ("assistant:",)), "a": (0, "", ())}
    for (role, text), fault in zip(rows[::-1], faults[::-1]):
        new = {}
        for state in best:
            options = [(2 + best[state][0], "D" + best[state][1], best[state][2])]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                after = "a" if state == "u" else "u"
                name = {"u": "user", "a": "assistant"}[after]
                c, e, lines = best[after]
                options.append((1 + extra + c, "R" + e, (f"{name}:{text}", *lines)))
                if role[:1] == after:
                    options.append((extra + c, "K" + e, (f"{role}:{text}", *lines)))
                if state == "" and role[:1] == "s":
                    c, e, lines = best["s"]
                    options.append((extra + c, "K" + e, (f"{role}:{text}", *lines)))
            new[state] = min(options)
        for _ in range(2):
            grown = {}
            for state in new:
                after = "a" if state == "u" else "u"
                c, e, lines = new[after]
                grown[state] = min(new[state], (5 + c, "I" + e, ({"u": "user:", "a": "assistant:"}[after], *lines)))
            new = grown
        best = new
    return best[""]


def expected(conversations):
    """The contract's row for each conversation: a dict of lists of (turn, role, text) in any order."""
    out = {}
    for conv, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        pairs = [(r[1], r[2]) for r in rows]
        faults = faults_of(pairs)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, lines = cheapest(pairs)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def spoiled(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def messy(seed, n):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "u2", "", "superuser", "User"]
    texts = ["Hi.", "Yes!", "no end", "What? ", "", " \t", "Ok.\n", "x. y", "é?", "…"]
    return [(pick.choice(roles[: pick.choice([2, 3, 8])]), pick.choice(texts) if pick.random() < 0.4 else f"say {pick.random()}{pick.choice(['.', '!', '', '  '])}") for _ in range(n)]


def codes_of(rows):
    out = ""
    for (role, _), fault in zip(rows, faults_of(rows)):
        code = role[:1] if role[:1] in ("s", "u", "a") else "x"
        out += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
    return out


def test_edits_by_exhaustive_search():
    """Blocks of any length give the cheapest edits, the least text among them."""
    for seed in range(400):
        rows = messy(seed, seed % 13)
        cost, audit, _ = cheapest(rows)
        codes, cuts = codes_of(rows), sorted(random.Random(seed).choices(range(len(rows) + 1), k=seed % 4))
        blocks = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        costs, after = C.block_costs(blocks), [C._END]
        for m in costs[::-1]:
            after.append((m + after[-1]).min(1))
        edits, ends = C.walks(blocks, np.array(after[:-1][::-1]), np.arange(len(blocks)) == len(blocks) - 1)
        state, got = 0, ""
        for e, to in zip(edits, ends):
            got, state = got + e[state], to[state]
        assert (int(after[-1][0]), got) == (cost, audit), (seed, rows)


@pytest.fixture(scope="module")
def odd():
    """Short and long conversations, null ids, turns, roles and texts, equal turns and repeated rows."""
    rows = []
    for conv in range(60):
        for turn, (role, text) in enumerate(messy(1000 + conv, conv % 11)):
            rows.append((conv, turn * (1 + conv % 3), role, text))
    rows += [(200, t, r, x) for t, (r, x) in enumerate(messy(5, 900))]
    rows += [(201, t // 3, r, x) for t, (r, x) in enumerate(messy(6, 120))]
    rows += [(202, 7, "user", "Again and again.")] * 300 + [(203, None, "user", "One."), (203, None, None, None), (203, 2, None, "Two."), (None, 1, "user", "A."), (None, None, "assistant", "B.")]
    rows += [(204, 1, "user", "word " * 300_000 + "."), (204, 2, "assistant", "Fine.")]
    rows += [(i, t, "user", "Gone.") for i in range(300, 1300) for t in range(1) if zlib.crc32(f"{i}:{t}".encode()) % 20 == 0][:3]
    return rows


def test_query_by_the_contract(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 2)
    frame = spark.createDataFrame([(*r, "row", "pos", "letter") for r in odd], CONVERSATIONS)
    frame.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in corpus_queries()["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got == expected(spoiled(odd)) and sum(not v[6] for v in got.values()) >= 3
    frame.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert corpus_queries()["op12_conversation_repair"](spark, f"{tmp_path}/none").collect() == []


def test_repaired_turns_are_legal(spark, odd):
    frame = spark.createDataFrame([(*r, "row", "pos", "letter") for r in odd], CONVERSATIONS)
    turns = {}
    for r in C.repair(frame).turns.collect():
        turns.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    asked = {conv: cheapest([(r, x) for _, r, x in rows])[2] for conv, rows in (
        (c, sorted([(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in odd if k == c], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())))
        for c in {r[0] for r in odd})}
    for conv, lines in asked.items():
        mine = [(role, text) for _, role, text in sorted(turns.get(conv, []))]
        assert [f"{r}:{x}" for r, x in mine] == list(lines)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in mine))


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in corpus_queries()["op12_conversation_repair"](spark, SF_DIR).collect()}
    assert got == expected(spoiled(rows)) and len(got) == len({r[0] for r in rows})
