"""Conversation repair against plain Python: all edits of short conversations, and a search over suffixes."""
import hashlib
import itertools
import random
import re
import zlib
from functools import cache

from cases import rows_of

from rowlog.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, Text2 string, audit int"
BLANKS = " \t\n\x0b\x0c\r"


def all_edits(letters):
    """(cost, audit) by trying every edit of every row and up to three inserts before each and at the end."""
    inserted = [x for k in range(4) for x in itertools.product("ua", repeat=k)]
    ways = []
    for x in letters:
        more = 1 if x.isupper() else 0
        here = [("D", 3, "")]
        if x != "x":
            here += [("K", more, x.lower() if x.lower() in "sua" else "?")] + [("R", 2 + more, r) for r in "ua"]
        ways.append([(i, h) for i in inserted for h in here])
    best = None
    for rows in itertools.product(*ways):
        for last in inserted:
            roles = "".join("".join(i) + h[2] for i, h in rows) + "".join(last)
            if re.fullmatch("(s?(ua)+)?", roles):
                cost = sum(2 * len(i) + h[1] for i, h in rows) + 2 * len(last)
                audit = "".join("I" * len(i) + h[0] for i, h in rows) + "I" * len(last)
                best = min(best or (cost, audit), (cost, audit))
    return best


def search(letters):
    """(cost, audit, roles) over suffixes, with whole strings."""
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def go(i, state, inserts=0):
        out = [(0, "", "")] if i == len(letters) and state in ("", "a") else []
        if inserts < 3:
            for r in nexts[state].replace("s", ""):
                c, a, w = go(i, r, inserts + 1)
                out.append((c + 2, "I" + a, "I" + r + w))
        if i < len(letters):
            x = letters[i]
            c, a, w = go(i + 1, state)
            out.append((c + 3, "D" + a, "D." + w))
            if x != "x":
                more = int(x.isupper())
                if x.lower() in nexts[state]:
                    c, a, w = go(i + 1, x.lower())
                    out.append((c + more, "K" + a, "K" + x.lower() + w))
                for r in nexts[state].replace("s", ""):
                    c, a, w = go(i + 1, r)
                    out.append((c + 2 + more, "R" + a, "R" + r + w))
        return min(out) if out else (10 ** 9, "~", "")

    return go(0, "")


def brute(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        kept = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns = [t for t, *_ in kept if t is not None]
        seen, letters, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.rstrip(BLANKS)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            x = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters.append("x" if fault < 2 else x.upper() if fault == 2 else x)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit, told = search("".join(letters))
        lines, at = [], 0
        for e, r in zip(told[::2], told[1::2], strict=True):
            name = {"u": "user", "a": "assistant"}.get(r)
            if e == "I":
                lines.append(f"{name}:")
                continue
            _, role, text = kept[at]
            at += 1
            if e != "D":
                lines.append(f"{role if e == 'K' else name}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed=1, n=150):
    r = random.Random(seed)
    words = ["Yes.", "No", "why?", "x\n y!\n", " ", "", "Ünï.", "end. \t"]
    out = []
    for c in range(n):
        for t in range(r.choice([1, 2, 3, 5, 8])):
            role = r.choice(["user", "assistant"]) if r.random() < 0.5 else "user" if t % 2 == 0 else "assistant"
            role = r.choice(["system", "tool", "", None, "User", "s"]) if r.random() < 0.1 else role
            text = None if r.random() < 0.03 else r.choice(words) + str(r.randrange(4)) * r.choice([0, 1]) + r.choice(["", ".", "."])
            out.append((c, t * r.choice([1, 1, 1, 2]), role, text, "z", 1))
    # One row a turn, so that the order of ties is no matter of hashes.
    return list({(c, t): (c, t, *rest) for c, t, *rest in out}.values())


def run(df):
    rows = cv.damaged(df)
    reports = cv.report(rows, "dropped")
    return cv.digest(reports, cv.repaired(rows, reports, "dropped"))


def test_equals_brute_force(spark):
    rows = made() + [(None, 0, "user", "Hi.", "", 1), (None, None, "assistant", "So.", "", 1), (None, 3, "assistant", "Good.", "", 1),
                     (999, 5, "user", None, "", 1), (998, None, None, None, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(run(df)) == brute(rows)
    assert run(df.where("false")).count() == 0


def test_whole_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert rows_of(run(df)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_every_edit_of_short_conversations():
    for n in range(3):
        for letters in itertools.product("xsuaoSUAO", repeat=n):
            s = "".join(letters)
            assert cv.Dawg().audit(s) == all_edits(s) == search(s)[:2], s
    for s in ("uau", "aUx", "sSu", "oua", "uux"):
        assert cv.Dawg().audit(s) == all_edits(s)


def test_suffixes_are_shared():
    r = random.Random(3)
    signatures = sorted({"".join(r.choice("uasxUA") for _ in range(r.randrange(9))) + "ua" * r.randrange(4) for _ in range(400)}, key=lambda s: s[::-1])
    dawg = cv.Dawg()
    for s in signatures:
        assert dawg.audit(s) == search(s)[:2]
    assert dawg.nodes == len({s[i:] for s in signatures for i in range(len(s) + 1)} | {""})


def test_a_long_conversation(spark):
    """Many rows in one conversation, and its copies under other ids; a column called `dropped` means nothing by itself."""
    one = [(t, "user" if t % 2 == 0 else "assistant", f"Text {t % 2000}." if t % 7 else f"cut {t}") for t in range(5000)]
    df = spark.createDataFrame([(c, *r, True) for c in (1, 2, 3) for r in one], "conv_id long, turn long, role string, text string, dropped boolean")
    reports = cv.report(df)
    got = [r.asDict() for r in reports.collect()]
    seen = {(r[1], r[2]) for r in one}
    assert len(got) == 3 and {r["duplicate"] for r in got} == {5000 - len(seen)} and {r["truncated"] for r in got} == {sum("cut" in r[2] for r in one)}
    assert len({(r["signature"], r["cost"], r["audit"]) for r in got}) == 1
    edits = cv.repaired(df, reports).groupBy("conv_id", "edit").count().collect()
    assert all(r["count"] == got[0]["audit"].count(r.edit) for r in edits)
    roles = "".join(r.role[0] for r in sorted(cv.repaired(df, reports).where("conv_id = 2").collect(), key=lambda r: r.place))
    assert re.fullmatch("(s?(ua)+)?", roles)
