"""Coercions, keys, facts from raw cells, constraint checks, table counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.functions.columns import durations_to_seconds, flag, iso_timestamp, number, session_id, slug, whole
from sixfold.operators import quality
from sixfold.operators.keys import assign_keys, new_members, resolve
from sixfold.plans import warehouse as wh
from sixfold.plans.inputs import table
from sixfold.sources.tables import absent, first_per_key, stored

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def slugs(spark, sf):
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t"), F.col("p_type"), F.lit(" / "), F.col("p_brand"), F.lit("! "))
    return table(spark, sf, "part").select("p_partkey", slug(raw).alias("slug"), session_id("p_size", "p_name", "p_brand").alias("session_id"))


def numbers(spark, sf):
    rows = table(spark, sf, "orders")
    kind = F.col("o_orderkey") % 5
    cell = (
        F.when(kind == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".75")))
        .when(kind == 1, F.col("o_orderpriority"))
        .when(kind == 2, F.lit("NaN"))
        .when(kind == 3, F.concat(F.lit("-"), F.col("o_custkey").cast("string")))
    )
    return rows.select(
        "o_orderkey",
        number(cell).alias("as_double"),
        whole(cell).alias("as_int"),
        number(cell, "decimal(12,1)").alias("as_decimal"),
        flag(F.when(kind == 0, "True").when(kind == 1, "False").when(kind == 2, "maybe")).alias("as_flag"),
    )


def timestamps(spark, sf):
    kind = F.col("o_orderkey") % 6
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cell = (
        F.when(kind == 0, day)
        .when(kind == 1, F.concat(day, F.lit("T10:11:12")))
        .when(kind == 2, F.concat(day, F.lit(" 10:11:12.250000")))
        .when(kind == 3, F.concat(day, F.lit("T10:11:12Z")))
        .when(kind == 4, F.concat(day, F.lit("T10:11:12+02:00")))
        .otherwise(F.concat(day, F.lit("T99:00:00")))
    )
    return table(spark, sf, "orders").select("o_orderkey", iso_timestamp(cell).alias("at"))


def durations(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return durations_to_seconds(lines.join(orders, "l_orderkey").withColumn("took", F.col("l_shipdate") - F.col("o_orderdate"))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "took"
    )


def dimension_keys(spark, sf):
    """Two loads of the part brands: the keys of the first stay, the second's follow without a gap."""
    part = table(spark, sf, "part")
    named = part.select(F.col("p_brand").alias("brand"))
    old = stored(assign_keys(part.where("p_size <= 2").select(F.col("p_brand").alias("brand")).distinct(), ["brand"], "brand_id"))
    both = stored(old.unionByName(new_members(old, named, "brand", "brand_id")))  # as in lap_facts
    kept = old.select("brand", F.col("brand_id").alias("_old_id"))
    members = both.agg(F.count(F.lit(1)).alias("_n")).scalar()
    checked = resolve(named, both, ["brand"], "brand_id").join(kept, "brand", "left")
    return checked.groupBy("brand", "brand_id", "_old_id").agg(F.count(F.lit(1)).alias("parts")).select(
        "brand",
        "parts",
        F.col("_old_id").isNotNull().alias("is_old"),
        (F.coalesce(F.col("_old_id"), F.col("brand_id")) == F.col("brand_id")).alias("is_stable"),
        F.col("brand_id").between(1, members).alias("in_range"),
    )


def first_orders(spark, sf):
    return first_per_key(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


def absent_orders(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    stored = table(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return absent(rows, stored, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def constraints(spark, sf):
    t = {name: table(spark, sf, name) for name in ("lineitem", "orders", "part", "supplier", "customer", "events", "embeddings")}
    small = t["part"].where("p_size < 40").select("p_partkey")
    rules = [
        quality.Rule("lineitem", "primary key", ("l_orderkey", "l_linenumber")),
        quality.Rule("orders", "primary key", ("o_orderkey",)),
        quality.Rule("part", "unique", ("p_brand",)),
        quality.Rule("lineitem", "foreign key", ("l_suppkey",), parent=("supplier", "s_suppkey")),
        quality.Rule("lineitem", "foreign key", ("l_partkey",), parent=("small", "p_partkey"), parent_name="part"),
        quality.Rule("orders", "foreign key", ("o_custkey",), parent=("customer", "c_custkey")),
        *[quality.Rule("events", "not null", (c,)) for c in ("event_id", "value")],
        *[quality.Rule("events", "json", (c,)) for c in ("props", "event_type")],
        quality.Rule("embeddings", "not null", ("vec_id",)),
        quality.Rule("embeddings", "length", ("embedding",), length=64),
        quality.Rule("embeddings", "length", ("embedding",), length=384, table="embeddings wide"),
    ]
    return quality.rule_report(t | {"small": small}, rules)


def repeated_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return quality.violating_rows(lines, ["l_orderkey", "l_linenumber"])


def table_counts(spark, sf):
    kinds = (("line", "Fact"), ("ev", "Fact"), ("embed", "Vector"), ("or", "Fact"), ("doc", "JSON"), ("nation", "Dimension"), ("region", "Dimension"))
    return quality.table_counts({name: table(spark, sf, name) for name in TABLES} | {"missing": None}, kinds)


# --- raw cells: the given tables written as the files' text ------------------------------------------------------------------


def _text(column):
    return F.col(column).cast("string")


def _weeks():
    return F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 7) + 1


def _entries(spark, sf):
    """Drivers by code and number per event, from raw results."""
    entry = wh.entries(raw_results(spark, sf))
    drivers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("driver_id"), F.upper("s_name").alias("driver_code"))
    return wh.event_drivers(entry, drivers.withColumn("driver_number", F.lit(None).cast("int")))


def raw_results(spark, sf):
    nation = table(spark, sf, "nation")
    return table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit(1).cast("bigint").alias("event_id"),
        F.concat(F.lit(" "), F.upper("s_name")).alias("Abbreviation"),
        F.concat(_text("s_suppkey"), F.lit(".0")).alias("DriverNumber"),
        F.col("n_name").alias("TeamName"),
        F.when(F.col("s_suppkey") % 3 == 0, "Finished").when(F.col("s_suppkey") % 3 == 1, " +3 Laps").alias("Status"),
        F.when(F.col("s_suppkey") % 4 == 0, "R").otherwise(F.concat(_text("s_suppkey"), F.lit(".0"))).alias("ClassifiedPosition"),
        F.concat(_text("s_suppkey"), F.lit(".0")).alias("Position"),
        F.when(F.col("s_suppkey") % 5 > 0, F.concat(_text("s_nationkey"), F.lit(".9"))).alias("GridPosition"),
        _text("s_nationkey").alias("Points"),
        F.lit("50").alias("Laps"),
        F.concat(_text("s_suppkey"), F.lit(".1236")).alias("Time"),
        F.lit("bad").alias("Q1"),
    )


def result_facts(spark, sf):
    names = raw_results(spark, sf).select(F.col("Status").alias("status_name"))
    seeds = wh.seed_statuses(spark)
    statuses = stored(seeds.unionByName(wh.status_members(names, seeds)))  # as in lap_facts
    facts = wh.result_facts(raw_results(spark, sf), _entries(spark, sf), statuses)
    return facts.join(statuses, "status_id", "left").select(
        "event_id", "driver_id", "grid_position", "final_position", "classified_position", "points", "laps_completed", "total_time_sec",
        "q1_time_sec", "q2_time_sec", "status_name", "is_classified",
    )


def _everyone(ids, code):
    """All the given ``id``s as drivers of one event, by ``code`` and number."""
    results = ids.select(F.lit(1).cast("bigint").alias("event_id"), code.alias("Abbreviation"), F.concat(_text("id"), F.lit(".0")).alias("DriverNumber"))
    drivers = ids.select(F.col("id").alias("driver_id"), code.alias("driver_code"), F.lit(None).cast("int").alias("driver_number"))
    return wh.event_drivers(wh.entries(results), drivers)


def lap_facts(spark, sf):
    """Every order line as a raw lap; all suppliers that the lines name are the drivers of one event."""
    ids = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("id")).distinct()
    # Dimensions are written first, as in a load: of known size, the few compounds are broadcast and no lap is dealt by its compound.
    entries = stored(_everyone(ids, F.concat(F.lit("SUPPLIER#"), F.lpad(_text("id"), 9, "0"))))
    lines = table(spark, sf, "lineitem").withColumn("_supplier", F.lpad(_text("l_suppkey"), 9, "0"))
    raw = lines.select(
        F.lit(1).cast("bigint").alias("event_id"),
        F.concat(F.lit("SUPPLIER#"), F.col("_supplier")).alias("Driver"),
        F.concat(_text("l_linenumber"), F.lit(".0")).alias("LapNumber"),
        F.when(F.col("l_tax") > 0, _text("l_quantity")).alias("LapTime"),
        F.when(F.col("l_returnflag") == "A", " soft ").when(F.col("l_returnflag") == "N", "c6").alias("Compound"),
        F.col("l_linestatus").alias("TrackStatus"),
        F.when(F.col("l_linestatus") == "O", "True").when(F.col("l_returnflag") == "R", "False").alias("IsAccurate"),
        _text("l_orderkey").alias("Time"),
        _text("l_discount").alias("SpeedI1"),
    )
    names = raw.select(F.col("Compound").alias("compound_name"))
    seeds = wh.seed_compounds(spark)
    compounds = stored(seeds.unionByName(wh.compound_members(names, seeds)))
    facts = wh.lap_facts(raw, entries, compounds).join(compounds, "compound_id", "left")
    return facts.select(
        "driver_id", "lap_number", "lap_time_sec", "compound_name", "compound_type", "is_accurate", "fresh_tyre", "track_status_code",
        "lap_start_time_sec", "speed_i1",
    )


def _raw_telemetry(spark, sf):
    """Every event is a sample with a time and a place, of its own user."""
    return table(spark, sf, "events").select(
        F.lit(1).cast("bigint").alias("event_id"),
        _text("user_id").alias("Driver"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("Date"),
        _text("event_id").alias("SessionTime"),
        _text("value").alias("Speed"),
        F.get_json_object("props", "$.k").alias("RPM"),
        F.when(F.col("event_type") == "click", "True").alias("Brake"),
        _text("value").alias("X"),
        _text("user_id").alias("Y"),
    )


def _users(spark, sf):
    return _everyone(table(spark, sf, "events").select(F.col("user_id").alias("id")).distinct(), F.concat(F.lit("USER"), _text("id")))


SAMPLE = ("driver_id", "sample_ts", "session_time_sec", "speed", "rpm", "brake", "x", "n_gear")


def telemetry_facts(spark, sf):
    return wh.telemetry_facts(_raw_telemetry(spark, sf), _users(spark, sf), stride=3).select(*SAMPLE)


def spatial_facts(spark, sf):
    return wh.spatial_facts(_raw_telemetry(spark, sf), _users(spark, sf), stride=4)


def series_facts(spark, sf):
    """Weather, track status and session status from one table of raw cells."""
    raw = table(spark, sf, "events").select(
        _weeks().alias("event_id"),
        _text("event_id").alias("Time"),
        _text("value").alias("AirTemp"),
        F.get_json_object("props", "$.k").alias("TrackTemp"),
        F.when(F.col("event_type") == "click", "True").otherwise("False").alias("Rainfall"),
        F.get_json_object("props", "$.k").alias("Status"),
        F.col("event_type").alias("Message"),
    )
    weather = wh.weather_facts(raw).select("event_id", "time_sec", "air_temp", "track_temp", "rainfall")
    track = wh.track_status_facts(raw)
    session = wh.session_status_facts(raw)
    return weather.join(track, ["event_id", "time_sec"]).join(session, ["event_id", "time_sec"])


def event_members(spark, sf):
    """Orders as sessions with their documents; keys come out dense and start after the stored ones."""
    orders = table(spark, sf, "orders")
    key = F.concat(F.lit("S"), _text("o_orderkey"))
    meeting = F.struct(F.col("o_orderpriority").alias("Location"), F.struct(F.col("o_orderstatus").alias("Code")).alias("Country"))
    nested = F.struct(meeting.alias("Meeting"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("StartDate"))
    data = F.struct(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("gp"), F.lit("R").alias("session_type"), nested.alias("data"))
    info = orders.select(key.alias("session_id"), F.to_json(F.struct(data.alias("data"))).alias("document"))
    stored = spark.createDataFrame([(10, "S0")], "event_id bigint, session_id string")
    events = wh.event_members(wh.sessions_of(info), info, stored)
    n = events.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return events.select(
        "session_id", "season", "gp_name", "gp_slug", "session_code", "circuit_name", "country_code", "session_start_ts",
        F.col("event_id").between(11, n + 10).alias("in_range"),
    )


def bridge_rows(spark, sf):
    entry = wh.entries(raw_results(spark, sf))
    none = spark.createDataFrame([], "event_id bigint, driver_id bigint, team_id bigint, driver_code string, team_name string")
    drivers, teams = stored(wh.driver_members(entry, none)), stored(wh.team_members(entry, none))  # as in lap_facts
    linked = wh.bridge_rows(entry, drivers, teams, none)
    named = linked.join(drivers.select("driver_id", "driver_code", "driver_number"), "driver_id").join(teams.select("team_id", "team_name"), "team_id")
    return named.select("event_id", "driver_code", "driver_number", "team_name")


def _count(table_name: str, rule: str, sql: str) -> str:
    return f"SELECT '{table_name}' AS \"table\", '{rule}' AS rule, ({sql})::BIGINT AS violations"


def _twice(table_name: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table_name} GROUP BY {key} HAVING count(*) > 1)"


QUERIES = {
    "slugs": (
        slugs,
        r"""SELECT p_partkey, regexp_replace(regexp_replace(trim(p_name || ' ' || chr(9) || p_type || ' / ' || p_brand || '!'), '\s+', '_', 'g'),
              '[^A-Za-z0-9_\-]', '', 'g') AS slug,
              p_size || '_' || regexp_replace(regexp_replace(p_name, '\s+', '_', 'g'), '[^A-Za-z0-9_\-]', '', 'g')
              || '_' || regexp_replace(p_brand, '[^A-Za-z0-9_\-]', '', 'g') AS session_id FROM part""",
    ),
    "numbers": (
        numbers,
        """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey + 0.75::DOUBLE WHEN 3 THEN -o_custkey::DOUBLE END AS as_double,
             CASE o_orderkey % 5 WHEN 0 THEN o_custkey WHEN 3 THEN -o_custkey END AS as_int,
             CASE o_orderkey % 5 WHEN 0 THEN o_custkey + 0.8::DOUBLE WHEN 3 THEN -o_custkey::DOUBLE END AS as_decimal,
             (CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS as_flag FROM orders""",
    ),
    "timestamps": (
        timestamps,
        """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN date_trunc('day', o_orderdate)
             WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL '10 hours 11 minutes 12.25 seconds'
             WHEN 5 THEN NULL ELSE date_trunc('day', o_orderdate) + INTERVAL '10 hours 11 minutes 12 seconds' END::TIMESTAMP AS "at" FROM orders""",
    ),
    "durations": (
        durations,
        """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, date_diff('second', o_orderdate, l_shipdate)::DOUBLE AS took
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "dimension_keys": (
        dimension_keys,
        """SELECT p_brand AS brand, count(*) AS parts, bool_or(p_size <= 2) AS is_old, true AS is_stable, true AS in_range FROM part GROUP BY p_brand""",
    ),
    "first_per_key": (
        first_orders,
        """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    ),
    "insert_absent": (
        absent_orders,
        """SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    ),
    "constraints": (
        constraints,
        " UNION ALL ".join(
            [
                _count("lineitem", "primary key l_orderkey,l_linenumber", _twice("lineitem", "l_orderkey, l_linenumber")),
                _count("orders", "primary key o_orderkey", _twice("orders", "o_orderkey")),
                _count("part", "unique p_brand", _twice("part", "p_brand")),
                _count("lineitem", "foreign key l_suppkey -> supplier.s_suppkey", "SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"),
                _count("lineitem", "foreign key l_partkey -> part.p_partkey", "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)"),
                _count("orders", "foreign key o_custkey -> customer.c_custkey", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
                _count("events", "not null event_id", "SELECT count(*) FROM events WHERE event_id IS NULL"),
                _count("events", "not null value", "SELECT count(*) FROM events WHERE value IS NULL"),
                _count("events", "json props", "SELECT count(*) FROM events WHERE NOT json_valid(props)"),
                _count("events", "json event_type", "SELECT count(*) FROM events WHERE NOT json_valid(event_type)"),
                _count("embeddings", "not null vec_id", "SELECT count(*) FROM embeddings WHERE vec_id IS NULL"),
                _count("embeddings", "length embedding = 64", "SELECT count(*) FROM embeddings WHERE len(embedding) <> 64"),
                _count("embeddings wide", "length embedding = 384", "SELECT count(*) FROM embeddings WHERE len(embedding) <> 384"),
            ]
        ),
    ),
    "violating_rows": (
        repeated_lines,
        """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM lineitem
           QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    ),
    "table_counts": (
        table_counts,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, count(*) AS row_count, '{kind}' AS table_type FROM {name}"""
            for name, kind in zip(
                TABLES,
                ("Dimension", "Dimension", "Other", "Other", "Other", "Fact", "Fact", "Fact", "JSON", "Vector", "Other", "Other", "Other", "Other"),
            )
        )
        + " UNION ALL SELECT 'missing', 0, 'Other'",
    ),
    "result_facts": (
        result_facts,
        """SELECT 1::BIGINT AS event_id, s_suppkey AS driver_id, CASE WHEN s_suppkey % 5 > 0 THEN s_nationkey::BIGINT END AS grid_position,
             s_suppkey AS final_position, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey END AS classified_position, s_nationkey::DOUBLE AS points,
             50::BIGINT AS laps_completed, (s_suppkey * 1000 + 124) / 1000 AS total_time_sec, NULL::DOUBLE AS q1_time_sec, NULL::DOUBLE AS q2_time_sec,
             CASE s_suppkey % 3 WHEN 0 THEN 'Finished' WHEN 1 THEN '+3 Laps' END AS status_name,
             CASE WHEN s_suppkey % 3 < 2 THEN 1::BIGINT END AS is_classified FROM supplier""",
    ),
    "lap_facts": (
        lap_facts,
        """SELECT l_suppkey AS driver_id, l_linenumber::BIGINT AS lap_number, CASE WHEN l_tax > 0 THEN l_quantity END AS lap_time_sec,
             CASE l_returnflag WHEN 'A' THEN 'SOFT' WHEN 'N' THEN 'C6' END AS compound_name,
             CASE l_returnflag WHEN 'A' THEN 'DRY' WHEN 'N' THEN 'OTHER' END AS compound_type,
             (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS is_accurate, 0::BIGINT AS fresh_tyre, NULL::BIGINT AS track_status_code,
             l_orderkey::DOUBLE AS lap_start_time_sec, round(l_discount + 1e-9, 1) AS speed_i1 FROM lineitem""",
    ),
    "telemetry_facts": (
        telemetry_facts,
        """SELECT user_id AS driver_id, date_trunc('second', ts)::TIMESTAMP AS sample_ts, event_id::DOUBLE AS session_time_sec, value AS speed,
             json_extract_string(props, '$.k')::DOUBLE AS rpm, (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS brake,
             value AS x, NULL::BIGINT AS n_gear
           FROM events QUALIFY (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) % 3 = 0""",
    ),
    "spatial_facts": (
        spatial_facts,
        """SELECT 1::BIGINT AS event_id, user_id AS driver_id, event_id::DOUBLE AS session_time_sec, value AS x, user_id::DOUBLE AS y, value AS speed,
             NULL::DOUBLE AS throttle, (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS brake
           FROM events e QUALIFY (row_number() OVER (PARTITION BY user_id ORDER BY e.event_id) - 1) % 4 = 0""",
    ),
    "series_facts": (
        series_facts,
        """SELECT date_diff('day', DATE '2024-01-01', ts::DATE) // 7 + 1 AS event_id, e.event_id::DOUBLE AS time_sec, value AS air_temp,
             k::DOUBLE AS track_temp, (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS rainfall, k::BIGINT AS status_code,
             event_type AS status_message, k AS status FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) e""",
    ),
    "event_members": (
        event_members,
        r"""SELECT 'S' || o_orderkey AS session_id, year(o_orderdate)::BIGINT AS season, o_orderpriority AS gp_name,
              regexp_replace(regexp_replace(o_orderpriority, '\s+', '_', 'g'), '[^A-Za-z0-9_\-]', '', 'g') AS gp_slug, 'R' AS session_code,
              o_orderpriority AS circuit_name, o_orderstatus AS country_code, o_orderdate::TIMESTAMP AS session_start_ts, true AS in_range
            FROM orders WHERE o_orderkey <> 0""",
    ),
    "bridge_rows": (
        bridge_rows,
        """SELECT 1::BIGINT AS event_id, upper(s_name) AS driver_code, s_suppkey AS driver_number, n_name AS team_name
           FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
}

#: Earlier names of the same queries.
QUERIES |= {f"{name}_all": QUERIES[name] for name in ("lap_facts", "telemetry_facts", "spatial_facts", "series_facts")}
