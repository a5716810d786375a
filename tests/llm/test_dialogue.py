import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import dialogue, queries
from tests.conftest import DATA

SPACE = " \t\n\v\f\r"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def brute(rows):
    """The cheapest edits by search from the end, and what they make of the rows."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]),
    )
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, said, inserts):
        """Cost and letters from row ``i`` on, after the initials ``said`` (their last two do)."""
        options = []
        if i == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", said):
                options.append((0, ""))
        else:
            go = best(i + 1, said, 0)
            options.append((go[0] + 2, "D" + go[1]))
            if faults[i] not in ("b", "d"):
                extra = 5 if faults[i] == "t" else 0
                for letter, initial, cost in (("K", rows[i][1][:1], 0), ("R", "u", 1), ("R", "a", 1)):
                    new = shorter(said + (initial or "?"))
                    if new is not None:
                        go = best(i + 1, new, 0)
                        options.append((go[0] + cost + extra, letter + go[1]))
        if inserts < 3:
            for initial in "ua":
                new = shorter(said + initial)
                if new is not None:
                    go = best(i, new, inserts + 1)
                    options.append((go[0] + 5, "I" + go[1]))
        return min(options, default=(float("inf"), ""))

    def shorter(said):
        """The same for what may follow: nothing longer than needed; None if it is no beginning."""
        if not re.fullmatch(r"s?(ua)*u?", said):
            return None
        while said.startswith(("uaua", "suaua")) or said == "suau":
            said = said[2:] if said.startswith("u") else "s" + said[3:]
            if said in ("su", "sua"):
                said = said[1:]
        return said

    cost, audit = best(0, "", 0)
    lines, at = [], 0
    for letter in audit:
        turn = len(lines) - (lines[0].startswith("s") if lines else 0)
        name = "user" if turn % 2 == 0 else "assistant"
        if letter == "I":
            lines.append(f"{name}:")
            continue
        _, role, text = rows[at]
        if letter != "D":
            lines.append(f"{role if letter == 'K' else name}:{text}")
        at += 1
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = (sum(f == k for f in faults) for k in "bdt")
    return (gaps, *counts, illegal, cost, audit, digest), lines


def damage(rows):
    """Rows as ``conv, turn, role, text`` and the conversations there are."""
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        out += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    return out, {c for c, *_ in rows}


def conversations(rows, every=()):
    out = {c: [] for c in every}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


def frame(spark, rows):
    extra = [(*r, "x", "y", 1) for r in rows]
    return spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, c string, t string, word int").repartition(3)


def check(rows, got):
    assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in got} == {c: brute(x)[0] for c, x in rows.items()}


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", "", None, "User", "s"])
            text = rng.choice(["Yes.", "No!", "why?", "and so", "  ", "", None, f"Row {t}. ", f"Row {t}"])
            rows.append((c, rng.choice([t, t, t + 1, t + 3, None]), role, text))
    return rows


def test_random_conversations(spark):
    rows = made(300, 1)
    check(conversations(rows), dialogue.repairs(frame(spark, rows), spill=8).collect())


def test_messages_are_those_of_the_digest(spark):
    rows = made(60, 2)
    df = frame(spark, rows)
    found = dialogue.repairs(df)
    got = {}
    for r in dialogue.messages(df, found).orderBy("conv_id", "position").collect():
        own = got.setdefault(r.conv_id, [])
        assert r.position == len(own)
        own.append(f"{r.role}:{r.text}")
    assert got == {c: lines for c, x in conversations(rows).items() if (lines := brute(x)[1])}


def test_a_long_conversation(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"Text {t}.", "no"])) for t in range(700)]
    got = dialogue.repairs(frame(spark, rows), spill=100).collect()
    (r,) = got
    want, _ = brute_long(rows)
    assert (r.cost, r.audit.count("I") + r.audit.count("D") * 0) == (want, r.audit.count("I"))
    lines = dialogue.messages(frame(spark, rows), dialogue.repairs(frame(spark, rows))).orderBy("position").collect()
    joined = "\n".join(f"{x.role}:{x.text}" for x in lines)
    assert r.repaired_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in lines))


def brute_long(rows):
    """The lowest cost alone, forwards."""
    costs, seen = {"": 0}, set()
    for _, _, role, text in rows:
        bad = (role, text) in seen
        seen.add((role, text))
        extra = 0 if text[-1] in ".!?" else 5
        for _ in range(2):
            for a, b in (("", "u"), ("u", "a"), ("a", "u")):
                if a in costs:
                    costs[b] = min(costs.get(b, 1e9), costs[a] + 5)
        new = {s: c + 2 for s, c in costs.items()}
        if not bad:
            for s, c in costs.items():
                to = "a" if s == "u" else "u"
                new[to] = min(new.get(to, 1e9), c + extra + (role[0] != to))
        costs = new
    return min(costs.get("", 1e9), costs.get("a", 1e9), costs.get("u", 1e9) + 5), None


def test_dropped_null_and_empty(spark):
    rows = [(None, None, None, None), (5, 1, "user", "Hi."), (5, 2, "assistant", "Hello."), (6, 1, "user", "Gone.")]
    df = frame(spark, rows)
    got = {r.conv_id: r for r in dialogue.repairs(df, dropped=F.col("conv_id").eqNullSafe(6)).collect()}
    assert tuple(got[6])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[5].audit, got[5].cost) == ("KK", 0)
    assert (got[None].audit, got[None].blank) == ("D", 1)
    assert dialogue.repairs(df.where("false")).count() == 0
    assert dialogue.messages(df.where("false"), dialogue.repairs(df.where("false"))).count() == 0


def test_text_keys_and_one_long_text(spark):
    df = spark.createDataFrame([("k", 1, "user", "é" * 2_000_000 + "."), ("k", 2, "assistant", "b.")], "conv_id string, turn int, role string, text string")
    (r,) = dialogue.repairs(df).collect()
    assert r.conv_id == "k" and r.audit == "KK"


@pytest.mark.parametrize("source", ["table", "made"])
def test_query(spark, tmp_path, source):
    folder = DATA
    if source == "made":
        folder = str(tmp_path)
        rows = [*made(80, 4), (None, 3, "user", "One."), (None, None, None, None)]
        frame(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    given = [tuple(r)[:4] for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    rows, every = damage(given)
    check(conversations(rows, every), queries.op11_dialogue(spark, folder).collect())
