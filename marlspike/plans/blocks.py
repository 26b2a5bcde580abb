"""Registered block query: records encoded from events by Spark, then decoded again."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.functions.blocks import header_fields
from marlspike.functions.hashing import reverse_bytes
from marlspike.operators.spread import spread
from marlspike.plans.registry import query
from marlspike.sources.tables import table


def _le(value, width):
    return reverse_bytes(F.lower(F.lpad(F.hex(value.cast("bigint")), 2 * width, "0")), width)


def records(spark, sf):
    """Hexadecimal payloads: 80-byte header, transaction count, body."""
    k = F.get_json_object("props", "$.k").cast("bigint") * 1000
    count = (
        F.when(k < 253, F.lower(F.lpad(F.hex(k), 2, "0")))
        .when(k < 65536, F.concat(F.lit("fd"), _le(k, 2)))
        .otherwise(F.concat(F.lit("fe"), _le(k, 4)))
    )
    header = F.concat(
        _le(F.lit(2), 4), F.sha2(F.concat(F.lit("p"), F.col("event_id").cast("string")), 256),
        F.sha2("props", 256), _le(F.unix_seconds(F.col("ts").cast("timestamp")), 4),
        _le(F.col("user_id"), 4), _le(F.col("event_id"), 4))
    return spread(table(spark, sf, "events")).select(
        "event_id", F.concat(header, count, F.lower(F.hex("event_type"))).alias("payload"))


REV = "array_to_string(list_reverse(regexp_extract_all({}, '..')), '')"
LE4 = REV.format("printf('%08x', {})")


BLOCKS = f"""
    WITH v AS (SELECT event_id, event_type, user_id, epoch_us(ts) // 1000000 AS t, (props::JSON->>'$.k')::BIGINT * 1000 AS k,
        sha256('p' || event_id) AS prev, sha256(props) AS merkle FROM events),
    h AS (SELECT *, '02000000' || prev || merkle || {LE4.format('t')} || {LE4.format('user_id')} || {LE4.format('event_id')} AS header FROM v)
    SELECT event_id, {REV.format('sha256(unhex(sha256(unhex(header))))')} AS block_hash, 2::BIGINT AS version,
      {REV.format('prev')} AS prev_block, {REV.format('merkle')} AS merkle_root, t AS timestamp, user_id AS bits, event_id AS nonce,
      k AS tx_count, (80 + CASE WHEN k < 253 THEN 1 WHEN k < 65536 THEN 3 ELSE 5 END + strlen(event_type))::BIGINT AS size
    FROM h
"""


@query("blk_header", BLOCKS)
def blk_header(spark, sf):
    return header_fields(records(spark, sf), "payload", F.length("payload") / 2)
