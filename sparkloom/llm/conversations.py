"""Rebuilding conversations from message rows.

Method: each speaker's clock (role and the way its times are written) gets an offset, estimated by least squares from
reply-before constraints: in every session the first user message must not follow the first reply, nor the last user
message the last reply. A missing message violates one of the two, a wrong clock both; a clock is held to be wrong only if
both are violated in most of its sessions; the corrected streams of
the speakers are merged by time, and conversations whose constraints stay infeasible, that is in which a user message
isn't directly followed by a reply, are rejected. Times that obey their constraints are left as stated.

Order is found by a range partitioning on session and time, so a session may be larger than a partition: each partition
sums up its part of a session (first and last speaker, whether a user message was followed by another), and the few parts
of a session are put together.

Defined results. Messages with null or white-space content count for nothing. Of rows with one message_id the earliest
counts; rows without a message_id are messages of their own, full copies among them one. A null session_id belongs to no
session. Ties in time put the user first, then go by message_id. Roles that mean none of user, assistant and system, and
times that can't be read, drop their session, as do a missing row in sessions and the lack of any message of user or
assistant. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.plans.shared import materialize

#: How speakers are spelled, after trimming and lower case. Fixed values.
ROLES = {
    "user": ["user", "用户", "human"],
    "assistant": ["assistant", "助手", "ai", "bot"],
    "system": ["system", "系统"],
}
_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|z|[+-]\d{2}(:?\d{2})?)?$"
_BLANK = r"^[\s\p{Z}\x{1C}-\x{1F}\x{85}]*$"


def speaker(role: Column) -> Column:
    """user, assistant or system; null if the role means none of them."""
    word = F.lower(F.regexp_replace(role, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.coalesce(*(F.when(word.isin(names), F.lit(name)) for name, names in ROLES.items()))


def instant(text: Column) -> Column:
    """Microseconds since 1970 of a time as written, or null. Digits only are milliseconds; no zone means UTC."""
    t = F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    zoned = F.when(t.rlike(r"([Zz]|[+-]\d{2}(:?\d{2})?)$") & t.rlike(r"[T ]\d{2}:\d{2}"), t).otherwise(F.concat(t, F.lit("Z")))
    zoned = F.regexp_replace(F.regexp_replace(F.upper(zoned), ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.regexp_replace(zoned, r"(T| )(\d{2}:\d{2})(Z|[+-])", "$1$2:00$3")
    iso = F.when(t.rlike(_ISO), F.unix_micros(zoned.try_cast("timestamp")))
    return F.when(t.rlike(r"^\d{1,18}$"), t.try_cast("bigint") * 1000).otherwise(iso)


def clean(messages: DataFrame) -> DataFrame:
    """session_id, message_id, speaker, at, clock, content: one row for each message that counts."""
    rows = messages.where("session_id IS NOT NULL AND content IS NOT NULL").where(~F.col("content").rlike(_BLANK))
    rows = rows.select("session_id", "message_id", "role", "created_at", "content", instant(F.col("created_at")).alias("at"))
    key = F.coalesce(F.concat(F.lit("m"), "message_id"), F.concat(F.lit("r"), F.sha2(F.to_json(F.struct("session_id", "role", "created_at", "content")), 256)))
    earliest = F.struct(F.coalesce("at", F.lit(2**62)).alias("rank"), "session_id", "message_id", "role", "created_at", "content", "at")
    one = rows.groupBy(key.alias("key")).agg(F.min(earliest).alias("m")).select("m.*")
    style = F.when(F.col("created_at").rlike(r"^\s*\d+\s*$"), "millis").otherwise(F.regexp_extract("created_at", r"\d{2}:\d{2}.*?(Z|[+-]\d{2}:?\d{2})?\s*$", 1))
    who = speaker(F.col("role"))
    return one.select("session_id", "message_id", who.alias("speaker"), "at", F.concat_ws("|", who, style).alias("clock"), "content")


def clock_offsets(messages: DataFrame, noise_us: int = 1_000_000) -> dict[str, int]:
    """Microseconds to add to each clock's times: the least squares solution of one equation for each pair of clocks, weighted
    by its constraints. A pair is held to be wrong where more than half of its constraints are violated at both ends, by two
    standard deviations; then its clocks are moved apart by what the replies are late, else left where they are. Offsets
    below noise_us are none. messages: cleaned. Only the sums by pair of clocks come to the driver: as many rows as there are
    ways to write a zone, squared."""
    told = messages.where("at IS NOT NULL AND speaker IN ('user', 'assistant')")
    ends = told.groupBy("session_id").agg(
        *(f(F.when(F.col("speaker") == who, F.struct("at", "clock"))).alias(f"{name}_{who}") for who in ("user", "assistant") for name, f in (("first", F.min), ("last", F.max)))
    )
    ends = ends.where("first_user IS NOT NULL AND first_assistant IS NOT NULL")
    wrong = (F.col("first_assistant.at") < F.col("first_user.at")) & (F.col("last_assistant.at") < F.col("last_user.at"))
    both = ends.select(wrong.alias("wrong"), F.explode(F.array(*(F.struct(F.col(f"{n}_user").alias("u"), F.col(f"{n}_assistant").alias("a")) for n in ("first", "last")))).alias("c"))
    slack = (F.col("c.a.at") - F.col("c.u.at")).cast("double")
    pairs = both.groupBy(F.col("c.u.clock").alias("u"), F.col("c.a.clock").alias("a")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("bad"), F.avg(F.when(F.col("wrong"), slack)).alias("late"), F.avg(F.when(slack >= 0, slack)).alias("usual")
    )
    rows = pairs.collect()
    wrong_pair = lambda r: r.bad * 2 > r.n + 2 * np.sqrt(r.n)
    clocks = sorted({c for r in rows for c in (r.u, r.a)})
    if not any(map(wrong_pair, rows)):
        return {c: 0 for c in clocks}
    usual = float(np.average([r.usual for r in rows if r.usual is not None] or [0.0]))
    # One equation for each pair of clocks, weighted by its constraints, and a weak one that keeps each clock as it is.
    a, b = np.zeros((len(rows) + len(clocks), len(clocks))), np.zeros(len(rows) + len(clocks))
    for i, r in enumerate(rows):
        w = np.sqrt(r.n)
        a[i, clocks.index(r.a)] += w
        a[i, clocks.index(r.u)] -= w
        b[i] = w * (usual - r.late) if wrong_pair(r) else 0.0
    a[len(rows) :] = np.eye(len(clocks)) * 1e-3
    found = np.linalg.lstsq(a, b, rcond=None)[0]
    return {c: int(o) if abs(o) >= noise_us else 0 for c, o in zip(clocks, found)}


def corrected(messages: DataFrame, offsets: dict[str, int]) -> DataFrame:
    """The cleaned messages with at moved by their clock's offset."""
    moved = {c: o for c, o in offsets.items() if o}
    if not moved:
        return messages
    table = F.create_map(*(F.lit(x) for pair in moved.items() for x in pair))
    return messages.withColumn("at", F.col("at") + F.coalesce(table[F.col("clock")], F.lit(0)))


def _ranged(messages: DataFrame, *columns: str) -> DataFrame:
    """Readable messages sorted by session and time over partitions, with the partition's number. User before assistant."""
    told = messages.where("at IS NOT NULL AND speaker IS NOT NULL")
    order = ["session_id", "at", F.when(F.col("speaker") == "system", 0).when(F.col("speaker") == "user", 1).otherwise(2), F.coalesce("message_id", F.lit(""))]
    return told.select("session_id", "at", "speaker", "message_id", *columns).repartitionByRange("session_id", "at").sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """session_id, part, first, last, broken, of runs of rows; a session that goes on in the next batch is carried on."""
    held = None
    for b in batches:
        s, who, part = (b.column(n).to_pylist() for n in ("session_id", "speaker", "part"))
        out = []
        for sid, w, p in zip(s, who, part):
            if held and held[0] == sid:
                held[4] |= held[3] == "user" and w == "user"
                held[3] = w
            else:
                if held:
                    out.append(held)
                held = [sid, p, w, w, False]
        if out:
            yield _summary(out)
    if held:
        yield _summary([held])


def _summary(rows: list[list]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["session_id", "part", "first", "last", "broken"])


def verdicts(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """session_id and reason (null if the conversation is kept) of every session of either table."""
    told = clean(messages)
    told = corrected(told, clock_offsets(told))
    ordered = _ranged(told.where("speaker != 'system'")).mapInArrow(_sum_up, "session_id string, part int, first string, last string, broken boolean")
    nothing = {"known": F.lit(0), "bad_role": F.lit(0), "bad_time": F.lit(0), "talk": F.lit(0), "run": F.lit(None).cast("struct<part:int,first:string,last:string,broken:boolean>")}
    mark = lambda df, **given: df.select("session_id", *((given.get(k, v)).alias(k) for k, v in nothing.items()))
    every = mark(sessions.where("session_id IS NOT NULL").select("session_id"), known=F.lit(1))
    every = every.unionByName(mark(messages.where("session_id IS NOT NULL").select("session_id")))
    talk = F.col("speaker").isin("user", "assistant")
    every = every.unionByName(mark(told, bad_role=F.col("speaker").isNull().cast("int"), bad_time=F.col("at").isNull().cast("int"), talk=F.coalesce(talk, F.lit(False)).cast("int")))
    every = every.unionByName(mark(ordered, run=F.struct("part", "first", "last", "broken")))
    by = every.groupBy("session_id").agg(*(F.max(k).alias(k) for k in ("known", "bad_role", "bad_time", "talk")), F.sort_array(F.collect_list("run")).alias("runs"))
    n = F.size("runs")
    joints = F.when(n > 1, F.exists(F.sequence(F.lit(1), n - 1), lambda i: (F.get("runs", i - 1)["last"] == "user") & (F.get("runs", i)["first"] == "user"))).otherwise(False)
    broken = (F.get("runs", F.lit(0))["first"] != "user") | (F.get("runs", n - 1)["last"] == "user") | F.exists("runs", lambda r: r["broken"]) | joints
    reason = F.when(F.col("known") == 0, "no session").when(F.col("bad_role") == 1, "role").when(F.col("bad_time") == 1, "time").when(F.col("talk") == 0, "empty").when(F.coalesce(broken, F.lit(True)), "order")
    return by.select("session_id", reason.alias("reason"))


def conversations(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """session_id, turn (from 0), speaker, at, message_id, content: the messages of the kept sessions in true order."""
    told = clean(messages)
    told = corrected(told, clock_offsets(told))
    kept = verdicts(messages, sessions).where("reason IS NULL").select("session_id")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, n = None, 0
        for b in batches:
            at = []
            for s in b.column("session_id").to_pylist():
                sid, n = (s, n + 1) if s == sid else (s, 0)
                at.append(n)
            yield b.append_column("place", pa.array(at, pa.int32()))

    ranged = _ranged(told.join(kept, "session_id", "left_semi"), "content")
    schema = "session_id string, at bigint, speaker string, message_id string, content string, part int, place int"
    turns = materialize(ranged.mapInArrow(number, schema), "turns")
    parts = turns.groupBy("session_id", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts"))
    spread = parts.where(F.size("parts") > 1)  # sessions that lie in several partitions
    before = spread.select("session_id", F.explode(F.transform("parts", lambda p: F.struct(p["part"].alias("part"), F.aggregate(F.filter("parts", lambda q: q["part"] < p["part"]), F.lit(0).cast("bigint"), lambda x, q: x + q["n"]).alias("skip")))).alias("p"))
    turns = turns.join(before.select("session_id", "p.part", "p.skip"), ["session_id", "part"], "left")
    return turns.select("session_id", (F.col("place") + F.coalesce("skip", F.lit(0))).alias("turn"), "speaker", F.timestamp_micros("at").alias("at"), "message_id", "content")
