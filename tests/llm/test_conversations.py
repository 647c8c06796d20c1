"""Conversation repair against an exhaustive search over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import conversations

SF = "/root/testdata/sf0.001"
COLS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def plain(rows, ids):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)} by a table of the best (cost, audit) per node."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv in ids:
        own = groups[conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]+", "", text)
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        first = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        after = {"": "u", "s": "u", "u": "a", "a": "u"}
        best = {(0, ""): (0, "", ())}
        for i in range(len(own) + 1):
            for _ in range(4):  # insertions
                for q in ("", "s", "u", "a"):
                    if (i, q) in best:
                        c, audit, given = best[i, q]
                        new = (c + 2, audit + "I", (*given, (after[q], None)))
                        if (i, after[q]) not in best or new < best[i, after[q]]:
                            best[i, after[q]] = new
            if i == len(own):
                break
            role = own[i][2]
            for q in ("", "s", "u", "a"):
                if (i, q) not in best:
                    continue
                c, audit, given = best[i, q]
                ways = [("D", q, 3, ())]
                if faults[i] not in ("b", "d"):
                    t = faults[i] == "t"
                    if role[:1] == "s" and q == "" or role[:1] and role[:1] == after[q]:
                        ways.append(("K", role[:1], 0 + t, ((role, i),)))
                    ways.append(("R", after[q], 2 + t, ((after[q], i),)))
                for label, to, cost, more in ways:
                    new = (c + cost, audit + label, given + more)
                    if (i + 1, to) not in best or new < best[i + 1, to]:
                        best[i + 1, to] = new
        cost, audit, given = min(best[len(own), q] for q in ("", "a") if (len(own), q) in best)
        names = {"u": "user", "a": "assistant"}
        text = "\n".join(f"{names.get(r, r)}:{'' if i is None else own[i][3]}" for r, i in given)
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def talk(rng, conv, n):
    text = lambda: rng.choice(["yes.", "no", "", "What?", " ", "a b c!", "x.\n"]) if rng.random() < 0.4 else f"t{rng.random()}" + rng.choice([".", ""])
    roles = ["user", "assistant", "system", "tool", "usher", "", None]
    return [
        (conv, None if rng.random() < 0.05 else k + (rng.random() < 0.1), rng.choices(roles, (9, 9, 2, 1, 1, 1, 1))[0], None if rng.random() < 0.03 else text())
        for k in range(n)
    ]


@pytest.mark.parametrize("rows_each", [None, 3])
def test_against_search(spark, rows_each):
    rng = random.Random(4)
    rows = [r for c in range(150) for r in talk(rng, c, rng.randrange(1, 14))]
    rows += talk(rng, None, 9) + talk(rng, 200, 160) + [(201, 3, "user", "hm.")] * 40 + [(202, k, "user", "hm.") for k in range(30)]
    rows += [(203, 1, "system", "s."), (204, 1, "assistant", "x" * 50_000 + ".")]
    df = spark.createDataFrame(rows, COLS).withColumns({"kind": F.lit(1), "hash": F.lit("x"), "conv": F.lit(2)}).repartition(7)
    null = lambda x: " " if x is None else x
    want = plain([(c, t, null(r), null(x)) for c, t, r, x in rows], {r[0] for r in rows})
    assert result(conversations.repair(df, rows_each=rows_each)) == want
    damaged = damage(rows)
    got = conversations.repair(conversations.damaged(df), among=df, rows_each=rows_each)
    assert result(got) == plain(damaged, {r[0] for r in rows})


def test_registered_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(conversations.op12_auction_repair(spark, SF)) == plain(damage(rows), {r[0] for r in rows})


def test_empty(spark):
    none = spark.createDataFrame([], COLS)
    assert conversations.repair(conversations.damaged(none)).count() == 0
    gone = result(conversations.repair(none, among=spark.createDataFrame([(1,)], "conv_id long")))
    assert gone == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_prices_are_distances():
    """Prices never exceed distances, and those on the traced way equal them."""
    rng = random.Random(5)
    for _ in range(200):
        items = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randrange(0, 9)))
        auction = conversations.Auction(items, [1] * len(items), conversations.END)
        whole = auction.distance(conversations.START)
        audit, spent, end = auction.trace(conversations.START)
        assert spent == whole and end in (conversations.START, conversations.ASSISTANT)
        for (i, s), price in auction.price.items():
            rest = conversations.Auction(items[i:], [1] * (len(items) - i), conversations.END)
            assert price <= rest.distance(s)
