import hashlib
import random

from pyspark.sql import functions as F

from verso.llm import chat_events as C
from verso.llm import queries

EVENT = "conv_id long, seq long, message long, kind string, role string, text string, formatted int"


def fold(events):
    """Plain fold of one log: {conv: [(role, text)]}."""
    none_first = lambda x: (x is not None, x if x is not None else 0)
    key = lambda e: (none_first(e[1]), (e[3] is not None, (e[3] or "").lower()), e[5] or "", (e[4] is not None, e[4] or ""))
    state = {}
    for conv, seq, msg, kind, role, text, _ in sorted(events, key=key):
        m = state.setdefault((conv, msg), {"at": seq, "role": None, "text": ""})
        if m["role"] is None and role is not None:
            m["role"] = role
        if kind and kind.lower() == "delta":
            m["text"] += text or ""
        elif kind and kind.lower() in ("edit", "regenerate"):
            m["text"] = text or ""
    out = {}
    for (conv, msg), m in sorted(state.items(), key=lambda kv: (none_first(kv[1]["at"]), kv[1]["role"] or "", kv[1]["text"], none_first(kv[0][1]))):
        out.setdefault(conv, []).append((m["role"] or "", m["text"]))
    return out


def check(spark, events, block):
    df = spark.createDataFrame(events, EVENT)
    out = C.render(C.reconstruct(df, block), block=block).cache()
    want = fold(events)
    got = {r.conv_id: r for r in C.read_back(out).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
    for r in out.collect():
        assert sum(m.before + m.take + m.after for m in r.mask) == len(r.formatted)
    return out


def test_random_logs_equal_plain_fold(spark):
    rnd = random.Random(12)
    parts = ["", "a", "\\", "### ", "</turn>", "</turn>\n", "\\h", "\\b", ": ", "#", "é漢", "\n", "</turn", ">", "##", None]
    events = []
    for conv in [*range(12), None]:
        order = list(range(1, 60))
        for seq in order[: rnd.randint(1, 59)]:
            text = "".join(p or "" for p in rnd.choices(parts, k=3)) if rnd.random() > 0.1 else None
            msg = rnd.randint(0, 5)
            role = rnd.choice(["user", "assistant", "odd: role", "### x\\c", None]) if rnd.random() < 0.6 else None
            events.append((conv, seq, msg, rnd.choice(["delta"] * 6 + ["edit", "regenerate", "ping", "DELTA", None]), role, text, 1))
    for block in (4, 64):
        check(spark, events, block)


def test_ties_repeats_nulls_and_empty(spark):
    events = [(1, 5, 0, "delta", "user", "x", 1)] * 2 + [(1, 5, 0, "edit", None, "e", 1)] * 2 + [(1, None, 9, "delta", "assistant", "first", 1), (1, 5, 4, "delta", "a", "t", 1)]
    check(spark, events, 64)
    empty = spark.createDataFrame([], EVENT)
    assert C.read_back(C.render(C.reconstruct(empty))).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r, x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: r for r in queries.op3_chat_events(spark, sf).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
        assert g.formatted_chars >= sum(len(x) for *_, x in turns)


def test_repeated_rows_are_repeated_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, None, None)], "conv_id long, turn long, role string, text string")
    r = C.read_back(C.render(C.reconstruct(C.events_of_rows(df)))).first()
    assert [tuple(t) for t in r.turns] == [("user", "hi"), ("user", "hi"), ("", "")]


def test_plan_has_no_python(spark):
    plan = queries.op3_chat_events(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
