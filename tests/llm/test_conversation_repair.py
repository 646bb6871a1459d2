"""Conversation repair: cheapest edits against plain dynamic programming, whole tables against plain Python."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from pricelens.llm import conversation_repair as C

PATTERN = re.compile(r"(s?(ua)+)?")


def least_edits(rows):
    """(cost, audit, repaired roles) by trying every end of every row in turn; rows are (initial, fault)."""
    labels = {"": (0, "", ())}  # state: "" nothing, else the last initial written
    made = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(labels):
        for _ in range(3):
            for state, (cost, audit, out) in list(labels.items()):
                new = made[state]
                label = (cost + 2, audit + "I", (*out, (new, None)))
                if new not in labels or label[:2] < labels[new][:2]:
                    labels[new] = label
        return labels

    labels = insert(labels)
    for j, (role, fault) in enumerate(rows):
        after = {}
        for state, (cost, audit, out) in labels.items():
            ways = [(state, 3, "D", out)]
            if fault not in "bd":
                more = fault == "t"
                if role == "s" and state == "" or role == made[state]:
                    ways.append((role, more, "K", (*out, (role, j))))
                ways.append((made[state], 2 + more, "R", (*out, (made[state], j))))
            for to, c, edit, new in ways:
                label = (cost + c, audit + edit, new)
                if to not in after or label[:2] < after[to][:2]:
                    after[to] = label
        labels = insert(after)
    return min((labels[s] for s in ("", "a") if s in labels), key=lambda x: x[:2])


def codes(rows):
    return "".join(r + f for r, f in rows)


def test_all_short_conversations():
    kinds = [(r, f) for r in "suax" for f in "kt"] + [("u", "b"), ("a", "d")]
    for n in range(4):
        for rows in product(kinds, repeat=n):
            assert C.cheapest(codes(rows)) == least_edits(rows)[:2]


@pytest.mark.parametrize("seed", range(30))
def test_random_and_pieced_conversations(seed, monkeypatch):
    r = random.Random(seed)
    rows = [(r.choice("suuaax"), r.choice("kkktbd")) for _ in range(r.randint(4, 60))]
    want = least_edits(rows)
    assert C.cheapest(codes(rows)) == want[:2]
    monkeypatch.setattr(C, "PIECE", r.randint(1, 7))
    monkeypatch.setattr(C, "FAN", 3)  # several levels of pieces
    assert C._between(codes(rows), 0, len(rows), C.START, C.ENDS) == want[:2]
    got = [(made, row if edit != "I" else None) for edit, row, made in C.replay(codes(rows), want[1]) if edit != "D"]
    assert [(m[0] if m else rows[j][0], j) for m, j in got] == list(want[2])
    assert PATTERN.fullmatch("".join(i for i, _ in want[2]))


def test_long_conversation():
    r = random.Random(9)
    rows = [(r.choice("sua"), r.choice("kktd")) for _ in range(3000)]
    assert C.cheapest(codes(rows)) == least_edits(rows)[:2]


# ── whole tables ────────────────────────────────────────────────────────────────

def plain(table):
    """conv_id to the contract's columns, from rows (conv_id, turn, role, text)."""
    convs, space = {}, lambda x: " " if x is None else str(x)
    for conv, turn, role, text in table:
        kept = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        tie = lambda x: hashlib.sha256((str(len(x[1])).zfill(12) + x[1] + x[2]).encode()).digest()
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], tie(x)))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "k" if solid[-1] in ".!?" else "t")
            seen.add((role, text))
        firsts = [r[1][:1] for r in rows]
        cost, audit, made = least_edits([(i if i in list("sua") else "x", f) for i, f in zip(firsts, faults, strict=True)])
        lines = []
        for initial, j in made:
            if j is None:
                lines.append({"u": "user", "a": "assistant"}[initial] + ":")
            else:
                role = rows[j][1] if firsts[j] == initial else {"u": "user", "a": "assistant"}[initial]
                lines.append(role + ":" + rows[j][2])
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(df):
    got = [tuple(r) for r in C.digests(*C.repair(C.damage(df), originals=df.select("conv_id"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len({g[0] for g in got}) == len(got)
    return {g[0]: g[1:] for g in got}


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, seen string, pos int").repartition(5)


def test_against_plain_python(spark):
    r = random.Random(3)
    texts = ["Yes.", "No", "why?", "", " \t", "Tail. \n", "é!", "long " * 3000 + "end.", "x "]
    rows = []
    for conv in range(120):
        for turn in range(r.randint(1, 12)):
            rows.append((conv, turn * r.choice([1, 1, 1, 2]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]),
                         r.choice(texts) + r.choice(["", str(turn)])))
    rows += [(500, t, "user" if t % 2 else "assistant", f"t{t % 700}.") for t in range(2000)]  # several blocks and pieces
    rows += [(None, None, "user", "hot.")] * 300 + [(None, 1, None, None), (None, 2, "assistant", "ok."), (7000, None, "user", "a."),
             (7000, None, "assistant", "b."), (7001, 2**62, "user", "a."), (7001, -2**62, "assistant", "b.")]
    assert run(make(spark, rows)) == plain(rows)


def test_empty_and_dropped(spark):
    df = make(spark, [])
    assert run(df) == {}
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert run(make(spark, [(lost, 0, "user", "hi")])) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert run(df) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
