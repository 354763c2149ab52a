"""JSON paths, trees, shredding, message feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from sixfold.operators import documents as docs
from sixfold.plans import views
from sixfold.plans.inputs import MESSAGES, message_documents, table
from sixfold.plans.warehouse import to_documents


def race_control_messages(spark, sf):
    events = table(spark, sf, "conversations").select(F.col("conv_id").alias("event_id"), F.lit("GP").alias("gp_name")).distinct()
    return views.race_control_messages({"f1_raw_documents": message_documents(spark, sf), "dim_event": events})


def _order_documents(spark, sf):
    place = F.struct(F.col("o_orderpriority").alias("Location"), F.struct(F.col("o_orderstatus").alias("Code")).alias("Country"))
    key = F.col("o_orderkey").cast("string")
    payload = F.struct(
        F.concat(F.lit("S"), key).alias("session_id"),
        F.col("o_orderstatus").alias("gp"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("Race")).alias("session_name"),
        F.struct(place.alias("Meeting"), F.col("o_totalprice").alias("Price")).alias("data"),
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.lit("session_info").alias("doc_type"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"),
    )


def _event_trees(spark, sf):
    """Nested documents: the event, its own JSON column as an object, and a seven-element array."""
    parts = [
        F.format_string('{"user":%d,"kind":"%s","note":null,"late":', "user_id", "event_type"),
        F.when(F.col("value") > 100, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"props":'),
        F.col("props"),
        F.lit(',"parts":[1,2,{"x":"abcdefghijklmnopqrstuvwxyz"},[8,9],5,6,7]}'),
    ]
    return table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.concat(*parts).alias("payload"))


def shred(spark, sf):
    body = F.concat(
        F.lit('{"items":[{"n":1,"user":'), F.col("user_id").cast("string"), F.lit('},{"n":2,"kind":"'), F.col("event_type"), F.lit('"},{"n":3}]}')
    )
    rows = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), body.alias("payload"))
    return docs.shred(rows, "$.items", "n bigint, user bigint, kind string")


def json_extract(spark, sf):
    events = table(spark, sf, "events")
    return docs.json_fields(events, {"k": ("$.k", "bigint"), "absent": ("$.no.such[0]", "string")}, payload="props", keep=["event_id"])


def _feed(spark, sf):
    return docs.message_feed(message_documents(spark, sf))


def whole_rows(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value", "props"
    )
    return to_documents(rows, "event", ["user_id", "event_type", "value", "props"])


_TREE = """
SELECT event_id AS doc_id, '' AS id, '' AS parent, 'session_info' AS label, 0::BIGINT AS value FROM events
UNION ALL SELECT event_id, 'user', '', 'user: ' || user_id, 1 FROM events
UNION ALL SELECT event_id, 'kind', '', 'kind: ' || event_type, 1 FROM events
UNION ALL SELECT event_id, 'note', '', 'note: None', 1 FROM events
UNION ALL SELECT event_id, 'late', '', CASE WHEN value > 100 THEN 'late: True' ELSE 'late: False' END, 1 FROM events
UNION ALL SELECT event_id, 'props', '', 'props', 1 FROM events
UNION ALL SELECT event_id, 'props/k', 'props', 'k: ' || json_extract_string(props, '$.k'), 1 FROM events
UNION ALL SELECT event_id, 'parts', '', 'parts', 1 FROM events
UNION ALL SELECT event_id, 'parts[' || i || ']', 'parts', '[' || i || ']', 1 FROM events, range(5) r(i)
UNION ALL SELECT event_id, 'parts[2]/x', 'parts[2]', 'x: abcdefghijklmnopqrstuvwxy', 1 FROM events
UNION ALL SELECT event_id, 'parts[3][' || i || ']', 'parts[3]', '[' || i || ']', 1 FROM events, range(2) r(i)"""

FEED = f"""{MESSAGES}, feed AS (
  SELECT doc_id, coalesce(category, 'Unknown') AS category, coalesce(flag, '') AS flag, message,
         CASE WHEN length(message) > 50 THEN substring(message, 1, 50) || '...' ELSE message END AS text_short,
         (seconds - (SELECT min(seconds) FROM messages))::DOUBLE AS time_sec, coalesce(lap, 0) AS lap
  FROM messages WHERE length(message) > 0)"""

QUERIES = {
    "json_extract": (
        json_extract,
        "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, NULL::VARCHAR AS absent FROM events",
    ),
    "race_control_messages": (
        race_control_messages,
        f"""WITH {MESSAGES} SELECT doc_id, event_id, 'GP' AS gp_name, msg_time, category, flag, 'Track' AS scope, message AS message_text,
              racing_number, lap FROM messages WHERE event_id IS NOT NULL""",
    ),
    "message_extract": (
        lambda spark, sf: docs.message_extract(message_documents(spark, sf), k=None),
        f"WITH {MESSAGES} SELECT doc_id, category, flag, substring(message, 1, 50) AS message_text, lap FROM messages",
    ),
    "session_extract": (
        lambda spark, sf: docs.session_extract(_order_documents(spark, sf)),
        """SELECT o_orderkey AS doc_id, 'S' || o_orderkey AS session_id, o_orderstatus AS gp_name,
             CASE WHEN o_custkey % 2 = 0 THEN 'Race' END AS session_name, o_orderpriority AS location FROM orders""",
    ),
    "json_flatten": (lambda spark, sf: docs.flatten_tree(_event_trees(spark, sf)), _TREE),
    "json_shred": (
        shred,
        """SELECT event_id AS doc_id, i::BIGINT AS item, i::BIGINT AS n, CASE WHEN i = 1 THEN user_id END AS "user",
             CASE WHEN i = 2 THEN event_type END AS kind FROM events, range(1, 4) r(i)""",
    ),
    "flag_summary": (
        lambda spark, sf: docs.flag_summary(race_control_messages(spark, sf)),
        f"""WITH {MESSAGES} SELECT flag, count(*) AS messages FROM messages WHERE event_id IS NOT NULL GROUP BY flag""",
    ),
    "message_feed": (_feed, f"WITH {FEED} SELECT * FROM feed"),
    "timeline": (
        lambda spark, sf: docs.timeline(_feed(spark, sf)).withColumn("race_minute", F.round("race_minute", 6)),
        f"""WITH {FEED}, o AS (SELECT category, row_number() OVER (ORDER BY min(doc_id)) - 1 AS y_pos FROM feed GROUP BY category)
            SELECT feed.*, round(time_sec / 60, 6) AS race_minute, y_pos FROM feed JOIN o USING (category)""",
    ),
    "whole_rows": (
        whole_rows,
        """SELECT event_id, 'event' AS doc_type, NULL::BIGINT AS driver_id,
             to_json({'user_id': user_id, 'event_type': nullif(event_type, 'error'), 'value': value, 'props': props})::VARCHAR AS payload FROM events""",
    ),
}
