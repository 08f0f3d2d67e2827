import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from txgraph.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string, gone string, place long"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def search(rows):
    """(cost, audit, repaired) by trying every edit, inserts anywhere included."""
    told, seen = [], set()
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            told.append("blank")
        elif (role, text) in seen:
            told.append("duplicate")
        else:
            told.append("truncated" if re.search(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)", text).group() not in ".!?" else None)
        seen.add((role, text))
    inserts = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    best = None
    own = []
    for (role, text), fault in zip(rows, told):
        options = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            options += [("K", extra, (role, text)), ("R", 3 + extra, ("user", text)), ("R", 3 + extra, ("assistant", text))]
        own.append(options)
    for choice in itertools.product(*own):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i in range(len(rows) + 1):
                for x in put[i]:
                    cost, audit = cost + 3, audit + "I"
                    out.append(({"u": "user", "a": "assistant"}[x], ""))
                if i < len(rows):
                    letter, price, kept = choice[i]
                    cost, audit = cost + price, audit + letter
                    if kept:
                        out.append(kept)
            if best is not None and (cost, audit) >= best[:2]:
                continue
            if GRAMMAR.match("".join(r[:1] or "?" for r, _ in out)):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def report(rows):
    """rows: (turn, role, text) without nulls in role and text."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    cost, audit, text = search([(r, t) for _, r, t in rows])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = dialogue.faults([(r, t) for _, r, t in rows])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def test_cheapest_equals_a_search_of_all_edits():
    rng = random.Random(11)
    for n, times in ((0, 1), (1, 40), (2, 60), (3, 40)):
        for _ in range(times):
            rows = [(rng.choice(["system", "user", "assistant", "tool", "u", ""]), rng.choice(["a.", "b!", "c", "", "d?"])) for _ in range(n)]
            roles, told = [r for r, _ in rows], dialogue.faults(rows)
            cost, letters = dialogue.cheapest(dialogue.kinds_of(roles, told))
            out = [(role, "" if at is None else rows[at][1]) for at, action, role in dialogue.replay(roles, letters) if action != "D"]
            assert (cost, "".join(letters), "\n".join(f"{r}:{t}" for r, t in out)) == search(rows), rows


def draw(rng, conv, n):
    return [
        (conv, rng.choice([None, rng.randrange(n + 1), rng.randrange(n + 1)]), rng.choice(["system", "user", "user", "assistant", "bot"]),
         rng.choice(["a.", "b!", "cut", " ", "d?\n", "e"]), "g", 1)
        for _ in range(n)
    ]


@pytest.mark.parametrize("bound", [4096, 1])
def test_report_equals_brute_force(spark, bound):
    """With a bound of one row all conversations take the way of the long ones, in chunks of one row."""
    rng = random.Random(bound)
    rows = [r for conv in [None, *range(16)] for r in draw(rng, conv, rng.randrange(1, 5))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in dialogue.report(df, rows=bound).collect()}
    want = {c: report([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want
    edits = dialogue.repair(df, rows=bound).orderBy("conv_id", "position").collect()
    for c, row in want.items():
        mine = [e for e in edits if e.conv_id == c]
        assert "".join(e.action for e in mine) == row[6] and [e.position for e in mine] == list(range(len(mine)))
        text = "\n".join(f"{e.role}:{e.text}" for e in mine if e.action != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == row[7]


def test_one_long_conversation_both_ways(spark):
    rng = random.Random(2)
    rows = [(7, i // 2, rng.choice(["system", "user", "assistant"]), rng.choice(["x.", f"{i}.", f"{i}", ""]), "", 0) for i in range(700)]
    rows += [(7, 9, "user", "again and again.", "", 0)] * 300 + [(8, 1, "user", "hi.", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole, cut = (sorted(map(tuple, dialogue.report(df, rows=bound).collect())) for bound in (4096, 64))
    assert whole == cut and len(whole) == 2
    edits = [sorted(map(tuple, dialogue.repair(df, rows=bound).collect())) for bound in (4096, 64)]
    assert edits[0] == edits[1]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!", "", 0) for c in range(40) for t in (0, 1, None)] + [(None, 3, None, None, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = []
    for c, t, role, text, *_ in rows:
        lot = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        want += [(c, t, "user" if lot == 4 else role, text, lot == 0)] * (2 if lot == 3 else 1)
    assert sorted(map(repr, map(tuple, dialogue.damage(df).collect()))) == sorted(map(repr, want))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, "", 0), (2, 1, "user", "q" * 1_200_000, "", 0)], SCHEMA)
    got = {r.conv_id: r for r in dialogue.report(df).collect()}
    assert (got[1].gaps, got[1].blank, got[1].cost, got[1].audit) == (0, 1, 4, "D")
    assert (got[2].truncated, got[2].cost, got[2].audit) == (1, 4, "D")
    gone = dialogue.report(df.withColumn("off", F.lit(True)), dropped="off").collect()
    assert {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(gone) == 2
    far = dialogue.report(df.withColumn("off", F.lit(True)), rows=0, dropped="off").collect()
    assert sorted(map(tuple, far)) == sorted(map(tuple, gone))
    assert dialogue.report(df.where("false")).count() == 0 == dialogue.repair(df.where("false")).count()
