import itertools
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from sparkloom.llm import conversations as C

MESSAGE = "message_id string, session_id string, role string, content string, created_at string"
SESSION = "session_id string, user_id string"
T0 = datetime(2026, 3, 1, 8, 0, tzinfo=timezone.utc)


def at(minutes):
    return (T0 + timedelta(minutes=minutes)).isoformat()


def talk(sid, roles, start=0, stamp=at):
    return [(f"{sid}-{i}", sid, r, f"text {i}", stamp(start + i)) for i, r in enumerate(roles)]


def run(spark, messages, sessions, clash=lambda x: x):
    v = C.verdicts(clash(spark.createDataFrame(messages, MESSAGE)), clash(spark.createDataFrame([(s, "u") for s in sessions], SESSION)))
    rows = v.collect()
    assert len({r.session_id for r in rows}) == len(rows)
    return {r.session_id: r.reason for r in rows}


def test_reasons(spark, clash):
    m = talk("ok", ["user", "assistant", "assistant", "用户", "AI"]) + talk("open", ["user", "assistant", "user"]) + talk("late", ["assistant", "user", "assistant"]) + talk("double", ["user", "Human ", "bot"])
    m += talk("odd", ["user", "assistant", "n/a"]) + talk("only", ["system"]) + talk("lost", ["user", "助手"]) + talk("mixed", [" USER", "系统", "Assistant"])
    m += [("t1", "time", "user", "x", at(0)), ("t2", "time", "assistant", "y", "2026-13-41T25:61:00+00:00")]
    m += [("b1", "blank", "user", " 　\n", at(0)), ("b2", "blank", "assistant", None, at(1)), (None, None, "user", "x", at(0))]
    m += [m[0], m[0]]  # full copies
    got = run(spark, m, ["ok", "open", "late", "double", "odd", "only", "time", "blank", "mixed", "never", None], clash)
    assert got == {"ok": None, "mixed": None, "open": "order", "late": "order", "double": "order", "odd": "role", "only": "empty", "lost": "no session", "time": "time", "blank": "empty", "never": "empty"}


def test_earliest_of_one_message_counts(spark):
    m = talk("s", ["user", "assistant", "user", "assistant"]) + [("s-1", "s", "assistant", "text 1", at(30)), ("s-2", "s", "user", "text 2", "unknown")]
    assert run(spark, m, ["s"]) == {"s": None}


def test_times_as_written(spark):
    values = {"2026-03-01T08:00:00+00:00": 0, "2026-03-01T16:00:00.5+08:00": 500_000, "2026-03-01 08:00:00": 0, "1772352000000": 0, "2026-03-01T08:00:00Z": 0, "2026-03-01T03:00:00-05:00": 0, "unknown": None, "": None, None: None, "0000-00-00T00:00:00": None}
    rows = spark.createDataFrame([(k,) for k in values], "t string").select("t", C.instant(F.col("t")).alias("at")).collect()
    base = int(T0.timestamp() * 1e6)
    assert {r.t: r["at"] and r["at"] - base for r in rows} == values


def test_a_wrong_clock_is_corrected(spark):
    behind = lambda minutes: (T0 + timedelta(minutes=minutes - 600)).strftime("%Y-%m-%d %H:%M:%S")
    m = []
    for i in range(40):
        users, bots = [(f"{i}u{k}", f"s{i}", "user", "q", at(i + 2 * k)) for k in range(3)], [(f"{i}a{k}", f"s{i}", "assistant", "a", behind(i + 2 * k + 1)) for k in range(3)]
        m += users + bots
    offsets = C.clock_offsets(C.clean(spark.createDataFrame(m, MESSAGE)))
    assert offsets["assistant|"] - offsets["user|+00:00"] > 9 * 3600 * 1_000_000
    right = C.clock_offsets(C.clean(spark.createDataFrame([x for i in range(40) for x in talk(f"s{i}", ["user", "assistant"] * 2)], MESSAGE)))
    assert set(right.values()) == {0}


def test_conversations_are_numbered_in_time(spark):
    rng = random.Random(4)
    m = [x for i in range(30) for x in talk(f"s{i}", ["system"] + ["user", "assistant"] * rng.randrange(1, 60))]
    rng.shuffle(m)
    rows = C.conversations(spark.createDataFrame(m, MESSAGE), spark.createDataFrame([(f"s{i}", "u") for i in range(30)], SESSION)).orderBy("session_id", "turn").collect()
    assert len(rows) == len(m)
    for _, g in itertools.groupby(rows, key=lambda r: r.session_id):
        g = list(g)
        assert [r.turn for r in g] == list(range(len(g))) and [r["at"] for r in g] == sorted(r["at"] for r in g)


def test_a_session_larger_than_a_partition(spark):
    m = talk("hot", ["user", "assistant"] * 3000, stamp=lambda i: at(i / 60)) + talk("bad", ["user", "assistant"] * 1500 + ["user"] + ["user", "assistant"] * 500, stamp=lambda i: at(i / 60))
    assert run(spark, m, ["hot", "bad"]) == {"hot": None, "bad": "order"}


def test_empty(spark):
    none = spark.createDataFrame([], MESSAGE)
    assert C.verdicts(none, spark.createDataFrame([], SESSION)).count() == 0
    assert C.conversations(none, spark.createDataFrame([], SESSION)).count() == 0


def test_conversations_need_the_corrected_clock(spark):
    """The assistant's clock, and no other, is ten hours behind: without its offset every session would be dropped."""
    behind = lambda minutes: (T0 + timedelta(minutes=minutes - 600)).strftime("%Y-%m-%d %H:%M:%S")
    m = [x for i in range(40) for k in range(3) for x in ((f"{i}u{k}", f"s{i}", "user", f"q{k}", at(i + 2 * k)), (f"{i}a{k}", f"s{i}", "assistant", f"a{k}", behind(i + 2 * k + 1)))]
    m += talk("broken", ["user", "user", "assistant"])
    got = run(spark, m, [*(f"s{i}" for i in range(40)), "broken"])
    assert got == {**{f"s{i}": None for i in range(40)}, "broken": "order"}
    turns = C.conversations(spark.createDataFrame(m, MESSAGE), spark.createDataFrame([("s7", "u")], SESSION)).orderBy("turn").collect()
    assert [t.content for t in turns] == ["q0", "a0", "q1", "a1", "q2", "a2"]


def test_few_sessions_teach_no_offset(spark):
    m = [x for i in range(3) for x in (("u%d" % i, f"s{i}", "user", "q", at(5)), ("a%d" % i, f"s{i}", "assistant", "a", at(1)))]
    assert set(run(spark, m, ["s0", "s1", "s2"]).values()) == {"order"}
