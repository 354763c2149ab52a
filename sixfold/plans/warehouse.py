"""From raw session files to the warehouse tables."""

from __future__ import annotations

import warnings
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sixfold import schema
from sixfold.functions.columns import flag, iso_timestamp, number, slug, text, whole
from sixfold.functions.embedding import embed
from sixfold.functions.vectors import unit
from sixfold.operators.keys import assign_keys, highest, new_members, resolve, row_ids
from sixfold.operators.ordered import HOT_ROWS, with_ordered
from sixfold.sources import bronze
from sixfold.sources.tables import ENDED, CommitConflict, Load, absent, read_warehouse


def _cell(df: DataFrame, name: str) -> Column:
    """A raw column, or NULL where the file lacks it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _ids(df: DataFrame) -> list[str]:
    """Key columns to carry along, and the place in the file that decides which of two rows with one key is kept."""
    return [c for c in ("event_id", "driver_id", "_row") if c in df.columns]


def _numbers(df: DataFrame, table: str, **sources: str) -> list[Column]:
    """Cast raw cells to the types of the named target columns."""
    kinds = {f.name: f.dataType for f in schema.struct(table)}
    return [number(_cell(df, raw), kinds[target]).alias(target) for target, raw in sources.items()]


# --- lookups and dimensions ----------------------------------------------------------------------------------------------


def seed_compounds(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(schema.COMPOUNDS, 1)]
    return spark.createDataFrame(rows, schema.struct("dim_compound"))


def seed_statuses(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(schema.STATUSES, 1)]
    return spark.createDataFrame(rows, schema.struct("dim_result_status"))


def compound_members(names: DataFrame, existing: DataFrame) -> DataFrame:
    """New compounds from a ``compound_name`` column (trimmed, upper case): SOFT, MEDIUM and HARD are DRY, the rest OTHER."""
    cleaned = names.select(F.upper(text("compound_name")).alias("compound_name")).distinct()
    typed = cleaned.withColumn("compound_type", F.when(F.col("compound_name").isin("SOFT", "MEDIUM", "HARD"), "DRY").otherwise("OTHER"))
    return new_members(existing, typed, "compound_name", "compound_id")


def status_members(names: DataFrame, existing: DataFrame) -> DataFrame:
    """New statuses from a ``status_name`` column: classified if the name holds ``Lap`` or is ``Finished``."""
    cleaned = names.select(text("status_name").alias("status_name")).distinct()
    classified = F.col("status_name").contains("Lap") | (F.col("status_name") == "Finished")
    return new_members(existing, cleaned.withColumn("is_classified", classified.cast("int")), "status_name", "status_id")


def event_members(sessions: DataFrame, info: DataFrame | None, existing: DataFrame) -> DataFrame:
    """New events. ``sessions``: session_id, season, gp_name, session_code. Nested fields come from the session document."""
    events = sessions.withColumn("gp_slug", slug("gp_name"))
    nested = {
        "session_name": "$.data.session_name",
        "circuit_name": "$.data.data.Meeting.Location",
        "country_code": "$.data.data.Meeting.Country.Code",
        "country_name": "$.data.data.Meeting.Country.Name",
        "_start": "$.data.data.StartDate",
    }
    if info is None:
        events = events.withColumns({name: F.lit(None).cast("string") for name in nested})
    else:
        parsed = info.select("session_id", F.try_parse_json("document").alias("_doc"))
        fields = [F.try_variant_get("_doc", path, "string").alias(name) for name, path in nested.items()]
        events = events.join(parsed.select("session_id", *fields), "session_id", "left")
    events = events.withColumn("session_start_ts", iso_timestamp("_start")).drop("_start")
    return new_members(existing, events, "session_id", "event_id")


def sessions_of(info: DataFrame) -> DataFrame:
    """Session id, season, grand prix and session code as written in the session documents."""
    doc = info.select("session_id", F.try_parse_json("document").alias("_doc"))
    return doc.select(
        "session_id",
        F.try_variant_get("_doc", "$.data.year", "int").alias("season"),
        F.try_variant_get("_doc", "$.data.gp", "string").alias("gp_name"),
        F.try_variant_get("_doc", "$.data.session_type", "string").alias("session_code"),
    )


def entries(results: DataFrame) -> DataFrame:
    """Who drove for whom per event, cleaned: the source of drivers, teams and the bridge."""
    return results.select(
        *_ids(results),
        text(_cell(results, "Abbreviation")).alias("driver_code"),
        whole(_cell(results, "DriverNumber")).alias("driver_number"),
        _cell(results, "FullName").alias("full_name"),
        _cell(results, "FirstName").alias("first_name"),
        _cell(results, "LastName").alias("last_name"),
        _cell(results, "CountryCode").alias("country_code"),
        text(_cell(results, "TeamName")).alias("team_name"),
        _cell(results, "TeamId").alias("team_code"),
        _cell(results, "TeamColor").alias("team_color"),
    ).where(F.col("driver_code").isNotNull())


def driver_members(entry: DataFrame, existing: DataFrame) -> DataFrame:
    """New drivers as first written: in the earliest event, then the earliest row."""
    columns = ["driver_code", "driver_number", "full_name", "first_name", "last_name", "country_code"]
    return new_members(existing, entry.select(*_ids(entry), *columns), "driver_code", "driver_id", order=_ids(entry))


def team_members(entry: DataFrame, existing: DataFrame) -> DataFrame:
    """New teams as first written."""
    columns = ["team_name", "team_code", "team_color"]
    return new_members(existing, entry.select(*_ids(entry), *columns), "team_name", "team_id", order=_ids(entry))


def bridge_rows(entry: DataFrame, drivers: DataFrame, teams: DataFrame, existing: DataFrame) -> DataFrame:
    """One team per driver and event."""
    linked = resolve(resolve(entry, drivers, ["driver_code"], "driver_id"), teams, ["team_name"], "team_id")
    order = [c for c in ("_row",) if c in linked.columns]
    return absent(linked.select("event_id", "driver_id", *order, "team_id"), existing, ["event_id", "driver_id"], order)


def event_drivers(entry: DataFrame, drivers: DataFrame) -> DataFrame:
    """Driver ids by code and by number, per event (numbers change hands between seasons)."""
    linked = resolve(entry.select("event_id", "driver_code", "driver_number"), drivers.drop("driver_number"), ["driver_code"], "driver_id")
    return linked.select("event_id", "driver_code", F.col("driver_number").cast("string").alias("driver_number"), "driver_id").distinct()


def _by_number(drivers: DataFrame) -> DataFrame:
    # Two drivers with one number in one event: keep the later key, as a plain map by number would.
    numbered = drivers.where(F.col("driver_number").isNotNull())
    return numbered.groupBy("event_id", "driver_number").agg(F.max("driver_id").alias("driver_id"))


# --- facts ---------------------------------------------------------------------------------------------------------------


def result_facts(results: DataFrame, drivers: DataFrame, statuses: DataFrame) -> DataFrame:
    raw = results.withColumns({"driver_code": text(_cell(results, "Abbreviation")), "status_name": text(_cell(results, "Status"))})
    raw = resolve(raw, drivers.select("event_id", "driver_code", "driver_id"), ["event_id", "driver_code"], "driver_id")
    raw = resolve(raw, statuses, ["status_name"], "status_id", how="left")
    values = _numbers(
        raw, "fact_result", grid_position="GridPosition", final_position="Position", classified_position="ClassifiedPosition",
        points="Points", laps_completed="Laps", total_time_sec="Time", q1_time_sec="Q1", q2_time_sec="Q2", q3_time_sec="Q3",
    )
    return raw.select(*_ids(raw), "status_id", *values)


def lap_facts(laps: DataFrame, drivers: DataFrame, compounds: DataFrame) -> DataFrame:
    raw = laps.withColumns({"driver_code": text(_cell(laps, "Driver")), "compound_name": F.upper(text(_cell(laps, "Compound")))})
    raw = resolve(raw, drivers.select("event_id", "driver_code", "driver_id"), ["event_id", "driver_code"], "driver_id")
    raw = resolve(raw, compounds, ["compound_name"], "compound_id", how="left")
    values = _numbers(
        raw, "fact_lap", lap_number="LapNumber", lap_time_sec="LapTime", sector1_sec="Sector1Time", sector2_sec="Sector2Time",
        sector3_sec="Sector3Time", stint_number="Stint", tyre_life="TyreLife", position="Position", pit_in_time_sec="PitInTime",
        pit_out_time_sec="PitOutTime", track_status_code="TrackStatus", speed_i1="SpeedI1", speed_i2="SpeedI2",
        speed_fl="SpeedFL", speed_st="SpeedST", lap_start_time_sec="Time",
    )
    flags = {"fresh_tyre": "FreshTyre", "is_personal_best": "IsPersonalBest", "is_accurate": "IsAccurate"}
    marks = [flag(_cell(raw, source)).alias(name) for name, source in flags.items()]
    return raw.select(*_ids(raw), "compound_id", *values, *marks).dropna(subset=["lap_number"])


#: The place of a sample among those of its event and driver, from 0.
PLACE = "_sample_no"


def placed_samples(telemetry: DataFrame, drivers: DataFrame, strides: Collection[int], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Raw samples with their place by time per event and driver: those that a sample of one of the ``strides`` takes.

    Samples without a time cannot be placed and are dropped, as are those of unknown drivers, before anything is sorted. One numbering
    serves all tables that are made from the samples.
    """
    timed = telemetry.withColumns(
        {"driver_number": text(_cell(telemetry, "Driver")), "session_time_sec": number(_cell(telemetry, "SessionTime"), "decimal(14,6)")}
    ).dropna(subset=["session_time_sec"])
    timed = resolve(timed, _by_number(drivers), ["event_id", "driver_number"], "driver_id")
    order = [c for c in ("session_time_sec", "_row") if c in timed.columns]
    if 1 in strides:  # all are taken: a number is needed only if another stride is, too
        if set(strides) == {1}:
            return timed.withColumn(PLACE, F.lit(0).cast("bigint"))
        taken = F.lit(True)
    else:
        taken = reduce(lambda a, b: a | b, [F.col(PLACE) % n == 0 for n in sorted(set(strides))])
    numbered = with_ordered(timed, ["event_id", "driver_number"], order, row_number=PLACE, hot_rows=hot_rows)
    return numbered.withColumn(PLACE, F.col(PLACE) - 1).where(taken)


def telemetry_rows(placed: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th of the placed samples as telemetry."""
    raw = placed.where(F.col(PLACE) % stride == 0)
    values = _numbers(
        raw, "fact_telemetry", speed="Speed", rpm="RPM", n_gear="nGear", throttle="Throttle", drs="DRS",
        x="X", y="Y", z="Z", distance="Distance",
    )
    stamp = iso_timestamp(_cell(raw, "Date")).alias("sample_ts")
    return raw.select(*_ids(raw), stamp, "session_time_sec", *values, flag(_cell(raw, "Brake")).alias("brake"))


def spatial_rows(placed: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th of the placed samples as a point: x and y as two plain columns, so that a box reaches the parquet scan."""
    raw = placed.where(F.col(PLACE) % stride == 0)
    values = _numbers(raw, "telemetry_spatial", x="X", y="Y", speed="Speed", throttle="Throttle")
    points = raw.select(*_ids(raw), "session_time_sec", *values, flag(_cell(raw, "Brake")).alias("brake"))
    return points.dropna(subset=["x", "y"])


def telemetry_facts(telemetry: DataFrame, drivers: DataFrame, stride: int = 10, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return telemetry_rows(placed_samples(telemetry, drivers, [stride], hot_rows), stride)


def spatial_facts(telemetry: DataFrame, drivers: DataFrame, stride: int = 50, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return spatial_rows(placed_samples(telemetry, drivers, [stride], hot_rows), stride)


def weather_facts(weather: DataFrame) -> DataFrame:
    values = _numbers(
        weather, "fact_weather", time_sec="Time", air_temp="AirTemp", track_temp="TrackTemp", humidity="Humidity",
        pressure="Pressure", wind_speed="WindSpeed", wind_direction="WindDirection",
    )
    rows = weather.select(*_ids(weather), *values, flag(_cell(weather, "Rainfall")).alias("rainfall"))
    return rows.dropna(subset=["time_sec"])


def track_status_facts(raw: DataFrame) -> DataFrame:
    values = _numbers(raw, "fact_track_status", time_sec="Time", status_code="Status")
    return raw.select(*_ids(raw), *values, _cell(raw, "Message").alias("status_message")).dropna(subset=["time_sec"])


def session_status_facts(raw: DataFrame) -> DataFrame:
    values = _numbers(raw, "fact_session_status", time_sec="Time")
    return raw.select(*_ids(raw), *values, _cell(raw, "Status").alias("status")).dropna(subset=["time_sec"])


# --- documents and messages ------------------------------------------------------------------------------------------------


def to_documents(df: DataFrame, doc_type: str, columns: list[str] | None = None) -> DataFrame:
    """Each whole row as one JSON object with explicit nulls, tagged with its type."""
    names = columns or [c for c in df.columns if c not in ("event_id", "doc_id")]
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    kept = [c for c in ("doc_id", "event_id") if c in df.columns]
    return df.select(*kept, F.lit(doc_type).alias("doc_type"), F.lit(None).cast("bigint").alias("driver_id"), payload.alias("payload"))


def message_documents(messages: DataFrame) -> DataFrame:
    """Race control messages as documents; numbers in the files stay numbers in the JSON."""
    names = [c for c in messages.columns if c not in ("doc_id", "event_id", "session_id", "_row")]
    typed = {"Lap": whole, "SessionTime": number}
    return to_documents(messages.withColumns({c: cast(c) for c, cast in typed.items() if c in names}), "race_control_message", names)


def info_documents(info: DataFrame) -> DataFrame:
    """The ``data`` part of each session document (the whole document where there is none)."""
    doc = F.try_parse_json("document")
    payload = F.to_json(F.coalesce(F.try_variant_get(doc, "$.data", "variant"), doc))
    driver = F.lit(None).cast("bigint").alias("driver_id")
    return info.select("doc_id", "event_id", F.lit("session_info").alias("doc_type"), driver, payload.alias("payload")).dropna(subset=["payload"])


def message_rows(messages: DataFrame) -> DataFrame:
    """Cleaned messages with the text to embed: ``category: message``, or the message alone."""
    category, message = text(_cell(messages, "Category")), text(_cell(messages, "Message"))
    stamp = iso_timestamp(_cell(messages, "Time"))
    seconds = F.when(_cell(messages, "Time").isNotNull(), number(_cell(messages, "SessionTime"), "decimal(14,6)"))
    combined = F.when(category.isNotNull(), F.concat(category, F.lit(": "), F.coalesce(message, F.lit("")))).otherwise(F.coalesce(message, F.lit("")))
    return messages.select(
        F.col("doc_id").alias("msg_id"),
        "event_id",
        stamp.alias("msg_ts"),
        seconds.alias("msg_time_sec"),
        category.alias("category"),
        _cell(messages, "Flag").alias("flag"),
        _cell(messages, "Scope").alias("scope"),
        message.alias("message_text"),
        combined.alias("embed_text"),
    )


# --- the whole load --------------------------------------------------------------------------------------------------------


def build_warehouse(
    spark: SparkSession,
    bronze_root: str,
    out: str,
    *,
    refresh: bool = True,
    telemetry_stride: int = 10,
    spatial_stride: int = 50,
    encoder=None,
    sessions: DataFrame | None = None,
    only: Collection[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
    attempts: int = 3,
) -> dict[str, DataFrame]:
    """Load the sessions found under ``bronze_root`` and return the stored tables.

    ``refresh`` rebuilds every table but the two lookups from all sessions. Otherwise only the files of sessions that are not loaded
    yet are read, and rows are compared with the stored rows of these events alone; messages of other events keep their ids
    and vectors. ``only`` names the sessions to read instead (with ``refresh=False``), also ones that are loaded: keys not stored
    yet are added, and their messages are replaced.

    A load is seen as a whole or not at all: until it commits, readers find the tables as they were, also after it broke off. If another
    load has ended meanwhile, this one begins anew on what that has stored, ``attempts`` times at most, so two loads never give out the
    same keys. Within a load each dimension is written before the facts read it back, so keys are fixed once and a lost executor
    cannot change them.
    ``sessions`` (session_id, season, gp_name, session_code) replaces what the session documents say.
    Only names and keys of sessions reach the driver, which lists their files anyway.
    """
    if refresh and only is not None:
        raise ValueError("only needs refresh=False")
    for left in reversed(range(attempts)):
        try:
            load = Load(spark, out, schema.LOOKUPS if refresh else None)
            if _load(load, bronze_root, refresh, telemetry_stride, spatial_stride, encoder, sessions, only, hot_rows):
                load.commit()
            break
        except CommitConflict:
            if not left:
                raise
    return read_warehouse(spark, out)


def _named(spark: SparkSession, sessions: Collection[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in sorted(sessions)], "session_id string")


def _load(load: Load, bronze_root: str, refresh: bool, telemetry_stride: int, spatial_stride: int, encoder, sessions: DataFrame | None, only, hot_rows) -> bool:
    """Write all tables of one load; False if there is nothing to load."""
    spark, chosen = load.spark, None
    if not refresh:
        known = [r.session_id for r in sessions.select("session_id").distinct().collect()] if sessions is not None else bronze.list_sessions(spark, bronze_root)
        chosen = set(only) if only is not None else set(known) - {r.session_id for r in load.read(ENDED).distinct().collect()}
        if known and not chosen:
            return False
    info = bronze.read_session_info(spark, bronze_root, chosen)
    if sessions is None:
        if info is None:
            raise ValueError("no session documents: pass sessions")
        sessions = sessions_of(info)
    elif chosen is not None:
        sessions = sessions.join(_named(spark, chosen), "session_id", "left_semi")
    raw = {dataset: bronze.read_dataset(spark, bronze_root, dataset, chosen) for dataset in schema.DATASETS}

    for table, seed in (("dim_compound", seed_compounds(spark)), ("dim_result_status", seed_statuses(spark))):
        name, key = schema.UNIQUE_KEYS[table][0], schema.PRIMARY_KEYS[table][0]
        missing = absent(seed, load.read(table), [name], [key])
        if load.read(table).isEmpty():
            load.append(missing, table)
        elif not missing.isEmpty():
            load.append(assign_keys(missing.drop(key), [name], key, highest(load.read(table), key)), table)

    load.append(event_members(sessions, info, load.read("dim_event")), "dim_event")
    # Stored, so that its size is known: a small one prunes the folders of other events from every scan that it is joined to.
    events = load.scratch(load.read("dim_event").join(sessions.select("session_id").distinct(), "session_id", "left_semi"), "events").where("event_id > 0")

    def with_event(df: DataFrame | None) -> DataFrame | None:
        return None if df is None else resolve(df, events, ["session_id"], "event_id")

    messages = raw.pop("race_control_messages")
    raw = {dataset: with_event(df) for dataset, df in raw.items()}

    drivers = None
    if raw["results"] is not None:
        entry = entries(raw["results"])
        load.append(driver_members(entry, load.read("dim_driver")), "dim_driver")
        load.append(team_members(entry, load.read("dim_team")), "dim_team")
        load.append(bridge_rows(entry, load.read("dim_driver"), load.read("dim_team"), load.read("bridge_driver_team")), "bridge_driver_team")
        statuses = raw["results"].select(_cell(raw["results"], "Status").alias("status_name"))
        load.append(status_members(statuses, load.read("dim_result_status")), "dim_result_status")
        # Written and read back: its size is then known, and a small one reaches the large facts without shuffling them.
        drivers = load.scratch(event_drivers(entry, load.read("dim_driver")), "drivers")
    if raw["laps"] is not None:
        compounds = raw["laps"].select(_cell(raw["laps"], "Compound").alias("compound_name"))
        load.append(compound_members(compounds, load.read("dim_compound")), "dim_compound")

    def add(table: str, rows: DataFrame) -> None:
        load.append(absent(rows, of_events(load.read(table), events), schema.PRIMARY_KEYS[table], ["_row"]), table)

    if drivers is None and (raw["laps"] is not None or raw["telemetry"] is not None):
        warnings.warn("no results files: laps and telemetry are not loaded, since their drivers are not known", stacklevel=3)
    if drivers is not None:
        add("fact_result", result_facts(raw["results"], drivers, load.read("dim_result_status")))
        if raw["laps"] is not None:
            add("fact_lap", lap_facts(raw["laps"], drivers, load.read("dim_compound")))
        if raw["telemetry"] is not None:
            # Numbered once and stored: only the samples that one of the two tables takes.
            placed = load.scratch(placed_samples(raw["telemetry"], drivers, [telemetry_stride, spatial_stride], hot_rows), "samples")
            add("fact_telemetry", telemetry_rows(placed, telemetry_stride))
            add("telemetry_spatial", spatial_rows(placed, spatial_stride))
    if raw["weather"] is not None:
        add("fact_weather", weather_facts(raw["weather"]))
    if raw["track_status"] is not None:
        add("fact_track_status", track_status_facts(raw["track_status"]))
    if raw["session_status"] is not None:
        add("fact_session_status", session_status_facts(raw["session_status"]))

    parts, after = [], load.read("f1_raw_documents").agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    if info is not None:
        parts.append(info_documents(with_event(row_ids(info, "doc_id", after))))
        after += info.agg(F.coalesce(F.max("_row"), F.lit(-1)) + 1).first()[0]
    if messages is not None:
        parts.append(message_documents(with_event(row_ids(messages, "doc_id", after))))
    if parts:
        load.append(new_documents(reduce(DataFrame.unionByName, parts), of_events(load.read("f1_raw_documents"), events)), "f1_raw_documents")
    if messages is not None:
        numbered = row_ids(messages, "doc_id", highest(load.read("f1_messages"), "msg_id"))
        load.replace(embedded_messages(with_event(numbered), encoder), "f1_messages")
    load.append(sessions.select("session_id").distinct(), ENDED)
    return True


def of_events(stored: DataFrame, events: DataFrame) -> DataFrame:
    """Stored rows of the given events. A small ``events`` is broadcast and leaves the folders of other events unread."""
    return stored.join(events.select("event_id"), "event_id", "left_semi")


def new_documents(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents of kinds that their event does not have yet; stored ones keep their ids."""
    return documents.join(stored.select("event_id", "doc_type").distinct(), ["event_id", "doc_type"], "left_anti")


def embedded_messages(messages: DataFrame, encoder=None) -> DataFrame:
    """Cleaned messages with their embedding as a vector of length 1."""
    embedded = message_rows(messages).withColumn("embedding", embed("embed_text", encoder))
    return embedded.withColumn("embedding", unit(F.col("embedding")).cast("array<float>"))
