import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from kestrel.llm import auction, conversations
from kestrel.llm.queries import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, cost int, part string, row binary, line string"
LETTERS = "suaoSUAOx"


def cheapest(letters):
    """Cost and least letters from the end, by relaxing every state."""
    inf = (10**9, "")
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
    add = {0: 2, 1: 2, 2: 3, 3: 2}
    best = [inf] * 4
    for i in range(len(letters), -1, -1):
        new = []
        for q in range(4):
            ways = [(0, "")] if i == len(letters) and q in (0, 3) else []
            if i < len(letters):
                x = letters[i]
                plus = lambda way, cost, letter: (way[0] + cost, letter + way[1])
                ways.append(plus(best[q], 3, "D"))
                if x != "x":
                    if q in step[x.lower()]:
                        ways.append(plus(best[step[x.lower()][q]], x.isupper(), "K"))
                    ways.append(plus(best[add[q]], 2 + x.isupper(), "R"))
            new.append(min(ways, default=inf))
        for _ in range(4):
            new = [min(new[q], (new[add[q]][0] + 2, "I" + new[add[q]][1])) for q in range(4)]
        best = new
    return best[0]


def brute(rows):
    """The contract, conversation by conversation."""
    damaged = {}
    for conv, turn, role, text in rows:
        out = damaged.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            out += [(turn, role, text)] * (1 + (kind == 3))
    got = []
    for conv, out in damaged.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:conversations.TIE],
                                hashlib.sha256(r[2].encode()).digest()))
        faults, seen, letters = Counter(), set(), ""
        for _, role, text in out:
            said = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not said else "duplicate" if (role, text) in seen
                     else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
            faults[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        turns = [t for t, _, _ in out if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
        cost, audit = cheapest(letters)
        lines, k, last = [], 0, ""
        for edit in audit:
            if edit in "KR":
                role = out[k][1] if edit == "K" else "assistant" if last == "u" else "user"
                lines.append(f"{role}:{out[k][2]}")
            elif edit == "I":
                role = "assistant" if last == "u" else "user"
                lines.append(f"{role}:")
            k += edit != "I"
            last = lines[-1][0] if lines else ""
        roles = "".join(line[0] for line in lines)
        assert re.fullmatch("(s?(ua)+)?", roles)
        got.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(got, key=str)


def made(rng, conv, n, nulls=True):
    texts = ["Yes.", "No!", "Why?", "cut", " \t", "", "a\u00a0", "Ends. \n", "é!"] + ([None] if nulls else [])
    roles = ["user", "assistant"] * 4 + ["system", "tool", "User", "us", ""] + ([None] if nulls else [])
    rows, turn = [], 0
    for _ in range(n):
        turn += rng.choice([0, 1, 1, 1, 3])
        rows.append((conv, rng.choice([None, turn]) if nulls and rng.random() < .1 else turn, rng.choice(roles),
                     rng.choice(texts) if rng.random() < .4 else f"Text {rng.randrange(10**6)}."))
    return rows


def report(spark, written, rows):
    full = [(*r, 7, "p", b"r", "l") for r in rows]
    df = op11_conversation_repair(spark, written(conversations=spark.createDataFrame(full, SCHEMA)))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def test_auction_against_brute_force():
    rng = random.Random(1)
    for k in range(1500):
        letters = "".join(rng.choices(LETTERS, [1, 6, 6, 1, 1, 2, 2, 1, 3], k=rng.randrange(40)))
        cost, audit = cheapest(letters)
        assert auction.edits(letters) == audit and auction.cost_of(letters, audit) == cost


@pytest.mark.parametrize("rows", [1, 5, 16])
def test_joined_segments_against_brute_force(monkeypatch, rows):
    monkeypatch.setattr(auction, "SEGMENT", rows)
    monkeypatch.setattr(auction, "DIRECT", 0)
    rng = random.Random(rows)
    for k in range(300):
        letters = "".join(rng.choices(LETTERS, [1, 6, 6, 1, 1, 2, 2, 1, 3], k=rng.randrange(90)))
        assert auction.edits(letters) == cheapest(letters)[1]
        at = rng.randrange(len(letters) + 1)
        parts = [letters[:at], letters[at:]]
        way = auction.states([auction.element(p) for p in parts], 0)
        assert "".join(auction.edits(p, way[i], way[i + 1], i == 1) for i, p in enumerate(parts)) == cheapest(letters)[1]


def test_op11_against_brute_force(spark, written):
    rng = random.Random(3)
    rows = [r for c in (None, *range(-20, 300)) for r in made(rng, c, rng.randrange(1, 9))]
    rows += made(rng, 1000, 700) + made(rng, 1001, 150)
    rows += [(2000, 1, "user", "x" * 300_000), (2000, 2, "assistant", "y." * 100_000)]
    rows += rows[::7]
    rng.shuffle(rows)
    assert report(spark, written, rows) == brute(rows)
    assert report(spark, written, []) == []


def test_a_conversation_over_many_tasks_and_chunks(spark, written, monkeypatch):
    """One conversation holds most rows, some of its turns many texts and equal rows."""
    monkeypatch.setattr(conversations, "CHUNK", 7)
    rng = random.Random(5)
    rows = made(rng, 5, 900, nulls=False) + [(5, 17, "user", "Again.")] * 40 + [
        (5, 18, "user", f"{k}.") for k in range(60)] + [r for c in range(8) if c != 5 for r in made(rng, c, 5)]
    rng.shuffle(rows)
    assert report(spark, written, rows) == brute(rows)


def test_rows_of_the_operator(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "system", "cut off"), (2, 0, "user", " ")],
        "conv_id long, turn long, role string, text string")
    done = conversations.stored(conversations.solved(conversations.stored(
        conversations.chunks(conversations._marked(conversations._keyed(rows))), f"{tmp_path}/c")), f"{tmp_path}/s")
    got = conversations.repaired(rows, done).orderBy("conv_id", "part", "run", "chunk", "place").select(
        "conv_id", "edit", "turn", "role", "text").collect()
    assert list(cheapest("axS")[1]) == ["I", "K", "D", "D"]
    assert list(map(tuple, got)) == [
        (1, "I", None, "user", ""), (1, "K", 0, "assistant", "Hello."), (1, "D", 1, "assistant", "Hello."),
        (1, "D", 2, "system", "cut off"), (2, "D", 0, "user", " ")]
