"""Queries of the operators for training data by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import containers, conversations, encoding, history, levels, mixing, packing, splits
from sparkloom.plans.shared import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return history.repeats(table(spark, d, "chunks"), table(spark, d, "build_runs")).select("record_id").distinct()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Repeating chunks by run."""
    found = history.repeats(table(spark, d, "chunks"), table(spark, d, "build_runs"))
    return found.groupBy("run_id", "place").agg(F.countDistinct("record_id").alias("repeating"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_oversized(table(spark, d, "chunks")).select("record_id").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_oversized(table(spark, d, "chunks")).distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Found by the learned mappings alone (and by U+FFFD); p3_restored also finds with the listed inverses."""
    return encoding.garbled_records(table(spark, d, "chunks"), table(spark, d, "dcd_cleaner"), listed=False).select("src_table", "row_id").distinct()


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_records(table(spark, d, "chunks"), table(spark, d, "dcd_cleaner")).distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return conversations.verdicts(table(spark, d, "messages"), table(spark, d, "sessions")).where("reason IS NOT NULL").select("session_id")


def p4_conversations(spark: SparkSession, d: str) -> DataFrame:
    return conversations.conversations(table(spark, d, "messages"), table(spark, d, "sessions"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.overlaps(table(spark, d, "chunks"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return splits.overlap_report(table(spark, d, "chunks"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return containers.fill_documents(table(spark, d, "documents"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return containers.fill_report(containers.fill_documents(table(spark, d, "documents")))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    found = levels.levels(table(spark, d, "documents"), table(spark, d, "level_labels"))
    return found.where("reading_level >= 4").select("doc_id").distinct()


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return levels.levels(table(spark, d, "documents"), table(spark, d, "level_labels")).select("doc_id", "reading_level")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return levels.profile(levels.levels(docs, table(spark, d, "level_labels")), docs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    mine = [p1_found, p1_report, p2_found, p2_pieces, p3_found, p3_restored, p4_found, p4_conversations, p5_found, p5_report]
    mine += [p8_containers, p8_report, p9_mix, p9_report, p10_found, p10_levels, p10_profile]
    return {f.__name__: f for f in mine}


_EDGE = r"[\s\p{Z}]"
_ROLES = " ".join(f"WHEN lower(r) IN ({', '.join(repr(n) for n in names)}) THEN '{role}'" for role, names in conversations.ROLES.items())
SQL = {
    "p2_found": "SELECT DISTINCT record_id FROM chunks WHERE len(regexp_extract_all(text, '[A-Za-z0-9]+|[\\x{4E00}-\\x{9FFF}]')) > 500",
    "p4_found": rf"""
    WITH m AS (SELECT DISTINCT session_id, message_id, role, created_at, content, regexp_replace(regexp_replace(coalesce(role, ''), '^{_EDGE}+', ''), '{_EDGE}+$', '') AS r,
      regexp_replace(regexp_replace(coalesce(created_at, ''), '^{_EDGE}+', ''), '{_EDGE}+$', '') AS c
      FROM messages WHERE session_id IS NOT NULL AND content IS NOT NULL AND NOT regexp_full_match(content, '[\s\p{{Z}}\x1C-\x1F\x{{85}}]*')),
    t AS (SELECT *, CASE WHEN regexp_full_match(c, '\d{{1,18}}') THEN c::BIGINT * 1000
      WHEN regexp_full_match(c, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}}([.,]\d+)?)?(Z|z|[+-]\d{{2}}(:?\d{{2}})?)?')
      THEN epoch_us(try_cast(CASE WHEN regexp_matches(c, '\d{{2}}:\d{{2}}.*([Zz]|[+-]\d{{2}}(:?\d{{2}})?)$') THEN c ELSE c || '+00:00' END AS TIMESTAMPTZ)) END AS moment FROM m),
    u AS (SELECT *, row_number() OVER (PARTITION BY coalesce('m' || message_id, concat_ws('|', session_id, role, created_at, content)) ORDER BY coalesce(moment, 4611686018427387904), session_id, role, created_at, content) AS n FROM t),
    v AS (SELECT session_id, message_id, moment, CASE {_ROLES} END AS who FROM u WHERE n = 1),
    w AS (SELECT session_id, moment, who, lead(who) OVER s AS after, row_number() OVER s AS place FROM v WHERE moment IS NOT NULL AND who IN ('user', 'assistant') WINDOW s AS (PARTITION BY session_id ORDER BY moment, who DESC, coalesce(message_id, ''))),
    broken AS (SELECT session_id FROM w WHERE (place = 1 AND who <> 'user') OR (who = 'user' AND coalesce(after, '') <> 'assistant')),
    every AS (SELECT session_id FROM sessions WHERE session_id IS NOT NULL UNION SELECT session_id FROM messages WHERE session_id IS NOT NULL)
    SELECT session_id FROM every WHERE session_id NOT IN (SELECT session_id FROM sessions WHERE session_id IS NOT NULL) OR session_id NOT IN (SELECT session_id FROM w)
      OR session_id IN (SELECT session_id FROM v WHERE who IS NULL OR moment IS NULL) OR session_id IN (SELECT session_id FROM broken)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
