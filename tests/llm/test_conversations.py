import hashlib
import random
import re
import zlib

import pytest

from gocledger.llm import conversations as C
from gocledger.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    """rows in order (turn, role, text) -> fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip("\t\n\x0b\x0c\r ")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("ok" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, lines) by trying every sequence of edits, cheapest and then ASCII-least."""
    marks, best = faults(rows), None
    todo = [(0, 0, "", "", ())]
    cap = 3 * len(rows) + 1
    while todo:
        i, cost, audit, form, lines = todo.pop()
        if cost > cap or form.endswith("x"):
            continue
        if i == len(rows) and FORM.fullmatch(form):
            found = (cost, audit, lines)
            if best is None or found[:2] < best[:2]:
                best, cap = found, cost
        for name in ("user", "assistant"):
            nxt = form + name[0]
            if grows(nxt):
                todo.append((i, cost + 2, audit + "I", nxt, lines + (f"{name}:",)))
        if i < len(rows):
            _, role, text = rows[i]
            todo.append((i + 1, cost + 3, audit + "D", form, lines))
            if marks[i] in ("ok", "truncated"):
                more = marks[i] == "truncated"
                if grows(form + (role[:1] or "x")):
                    todo.append((i + 1, cost + more, audit + "K", form + role[:1], lines + (f"{role}:{text}",)))
                for name in ("user", "assistant"):
                    if grows(form + name[0]):
                        todo.append((i + 1, cost + 2 + more, audit + "R", form + name[0], lines + (f"{name}:{text}",)))
    return best


def grows(form):
    """Whether a form can still become whole."""
    body = form[1:] if form[:1] == "s" else form
    return all(c == "ua"[i % 2] for i, c in enumerate(body))


def report(rows):
    rows = order([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
    marks = faults(rows)
    cost, audit, lines = brute(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def got(spark, rows, **kw):
    out = C.repair_report(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    return {r.conv_id: tuple(r)[1:] for r in out}


def conversation(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Hi.", "Well!", "no end", " ", "", "Hi. \n", "done?\x0b", "?", None, "é日.", "x ", ". no"]
    turns = [rng.choice([None, 0, 1, 2, 3, 5, 9]) for _ in range(n)]
    return [(t, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choices(texts, [9, 5, 4, 1, 1, 1, 2, 1, 1, 2, 1, 1])[0]) for t in turns]


def test_equals_brute_force(spark):
    rng = random.Random(13)
    convs = {c: conversation(rng, rng.randrange(1, 6)) for c in range(250)}
    found = got(spark, [(c, *r) for c, rows in convs.items() for r in rows])
    assert set(found) == set(convs)
    for c, rows in convs.items():
        assert found[c] == report(rows), rows


def test_long_conversation_over_batches_and_spills(spark):
    """The streamed result does not depend on Arrow batches or on what is spilled."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Text {t}.", "twice.", "open", " "])) for t in range(5000)]
    rows += [(8, t, "user", f"q{t}.") for t in range(50)]
    want = got(spark, rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert got(spark, rows, spill_bytes=300) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(re.sub("I", "", want[7][6])) == 5000 and want[7][2] > 0
    assert want[8][5:7] == (50, "KR" * 25)


def test_repaired_rows_agree_with_the_report(spark):
    rng = random.Random(17)
    rows = [(c, *r) for c in range(60) for r in conversation(rng, rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    lines = {}
    for r in C.repaired_rows(df).orderBy("conv_id", "slot").collect():
        assert (r.source_row is None) == (r.edit == "I") and r.slot == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for c, row in got(spark, rows).items():
        mine = lines.get(c, [])
        assert FORM.fullmatch("".join(x[0] for x in mine))
        assert hashlib.sha256("\n".join(mine).encode()).hexdigest() == row[-1]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "Hi."), (1, None, "assistant", "Ho."), (2, 0, "user", ""),
            (3, 0, "user", "a" * 200_000 + "."), (3, 1, "assistant", "b. " * 50_000), (4, 2, "user", "x."), (4, 2, "user", "x."),
            (5, -2 ** 63, "user", "x."), (5, 2 ** 63 - 1, "assistant", "y.")]
    found = got(spark, rows)
    assert found[1] == report([(None, "user", "Hi."), (None, "assistant", "Ho.")])
    assert found[2][5:7] == (3, "D") and found[2][7] == hashlib.sha256(b"").hexdigest()
    assert found[3][6] == "KK" and found[4][2] == 1 and found[5][0] == 2 ** 63 - 1
    assert found[None] == report([(None, None, None), (3, "user", "Hi.")])


def test_empty_clash_string_ids_and_absent_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(df).collect() == [] and C.repaired_rows(df).collect() == [] and C.repair_report(C.damaged(df)).collect() == []
    df = spark.createDataFrame([("a", 0, "user", "x."), ("a", 1, "assistant", "y.")], "conv_id string, turn int, role string, text string")
    more = df.selectExpr("*", "1 as initial", "'q' as FAULT", "2 as conv", "3 as gaps", "4 as kind", "conv_id != 'a' as present")
    r = C.repair_report(more).collect()[0]
    assert tuple(r) == ("a", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert C.repair_report(more, present=None).collect()[0].audit == "KK"


def test_damage_and_query_digest(spark):
    sf = "/root/testdata/sf0.001"
    raw = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = {}
    for c, t, role, text in raw:
        rows = hurt.setdefault(c, [])
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversations(spark, sf).collect()}
    assert set(found) == set(hurt)
    small = {c: rows for c, rows in hurt.items() if len(rows) <= 7}
    assert small and all(found[c] == report(rows) for c, rows in small.items())


@pytest.mark.parametrize("n", [0, 1, 40])
def test_spool_reads_back(n):
    spool, want = C._Spool(16), b"".join(bytes([i]) * 4 for i in range(n))
    for i in range(n):
        spool.add(bytes([i]) * 4)
    assert b"".join(spool.blocks(12)) == want
    assert b"".join(reversed(list(spool.blocks_back(12)))) == want
    spool.close()


def test_seen_digests_spill():
    seen = C._Seen(64 * 8)
    digests = [hashlib.blake2b(bytes([i % 50]), digest_size=16).digest() for i in range(200)]
    assert [seen.add(d) for d in digests] == [i < 50 for i in range(200)] and seen.runs
    seen.close()
