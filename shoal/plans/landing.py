"""Registered queries: the daily rates load and the weather ELT, end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shoal import functions as X
from shoal import sinks as W
from shoal import sources as S
from shoal.operators.loads import idempotent_append, replace_late
from shoal.plans.base import load, query
from shoal.session import scratch_path

# ---------------------------------------------------------------- 3.1 daily rates


def land_rates(spark, sf, path: str) -> None:
    """Rates documents as JSON Lines, one per event: base = event type, a rate
    map and the text date of the update (derived from events)."""
    ev = load(spark, sf, "events")
    rates = F.map_concat(F.from_json("props", "map<string,double>"),
                         F.create_map(F.lit("USD"), F.col("value")))
    doc = ev.select(F.col("event_type").alias("base"), F.date_format("ts", "yyyy-MM-dd").alias("last_update"),
                    rates.alias("rates"), F.col("ts").alias("fetched_at"), F.col("event_id").alias("seq"))
    W.write_json(doc, path)


RATES_SCHEMA = "base string, last_update string, rates map<string,double>, fetched_at timestamp_ntz, seq bigint"


@query("rates_daily_load", """
SELECT event_type AS base, CAST(ts AS DATE) AS last_update, CAST(value AS DOUBLE) AS usd,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(0 AS DOUBLE) AS cad
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
""")
def rates_daily_load(spark, sf):
    """Land → read with a schema → map lookups (case as stored, missing → NULL)
    → text date to DATE → dedup per (base, day) keeping the latest fetch → fill
    0 → append by name, twice: the re-run adds nothing."""
    landing = scratch_path(spark, "rates_landing")
    land_rates(spark, sf, landing)
    table = f"rates_{uuid.uuid4().hex[:10]}"
    # target column order differs from the batch: the insert must go by name
    spark.sql(f"CREATE TABLE {table} (base STRING, last_update DATE, cad DOUBLE, k DOUBLE, usd DOUBLE) "
              f"USING parquet LOCATION '{scratch_path(spark, table)}'")
    for _run in range(2):
        raw = S.read_json_lines(spark, landing, RATES_SCHEMA)
        batch = raw.select("base", F.to_date("last_update", "yyyy-MM-dd").alias("last_update"),
                           F.try_element_at("rates", F.lit("USD")).alias("usd"),
                           F.try_element_at("rates", F.lit("k")).alias("k"),
                           F.try_element_at("rates", F.lit("CAD")).alias("cad"),
                           "fetched_at", "seq")
        idempotent_append(spark, batch, table, ["base", "last_update"], ["fetched_at", "seq"],
                          fill=["usd", "k", "cad"], range_col="last_update")
    return spark.table(table)


@query("rates_late_rows", """
SELECT event_type AS base, CAST(ts AS DATE) AS last_update, CAST(value AS DOUBLE) AS usd, event_id AS seq
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
""")
def rates_late_rows(spark, sf):
    """The daily load when rows come late: first the fetches of each day's morning, then those of its afternoon, which correct them, then
    the mornings again (stale) and the afternoons again (a rerun). Each day keeps the last fetch."""
    table = f"rates_late_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE TABLE {table} (usd DOUBLE, base STRING, fetched_at TIMESTAMP_NTZ, seq BIGINT, last_update DATE) USING parquet "
              f"PARTITIONED BY (last_update) LOCATION '{scratch_path(spark, table)}'")
    rates = load(spark, sf, "events").select(F.col("event_type").alias("base"), F.to_date("ts").alias("last_update"), F.col("value").alias("usd"),
                                             F.col("ts").alias("fetched_at"), F.col("event_id").alias("seq"))
    morning, afternoon = rates.where(F.hour("fetched_at") < 12), rates.where(F.hour("fetched_at") >= 12)
    for batch in (morning, afternoon, morning, afternoon):
        replace_late(spark, batch, table, ["base", "last_update"], ["fetched_at", "seq"], "last_update", fill=["usd"])
    return spark.table(table).select("base", "last_update", "usd", "seq")


# ---------------------------------------------------------------- 3.3 weather ELT


def land_forecasts(spark, sf, path: str) -> None:
    """A text landing CSV whose ``list`` column holds a Python-style (single
    quoted) array of forecast entries, one document per event; error events
    carry a ``None`` that strict JSON cannot parse."""
    ev = load(spark, sf, "events")
    entry = F.struct(
        F.col("event_id").alias("id"),
        X.epoch_seconds("ts").alias("dt"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
        F.struct(F.col("value").alias("temp"),
                 F.get_json_object("props", "$.k").cast("int").alias("humidity")).alias("main"),
        F.lit(0.5).alias("pop"),
        F.when(F.col("event_type") == "purchase",
               F.struct((F.col("value") / 100).alias("3h"))).alias("rain"),
        F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"))
    text = F.replace(F.to_json(F.array(entry)), F.lit('"'), F.lit("'"))
    text = F.when(F.col("event_type") == "error", F.replace(text, F.lit("'pop':0.5"), F.lit("'pop':None"))) \
        .otherwise(text)
    landed = ev.select(F.lit("200").alias("cod"), F.col("user_id").cast("string").alias("city"), text.alias("list"))
    W.write_csv(landed, path)


FORECAST_ENTRY = ("id bigint, dt bigint, dt_txt string, main struct<temp: double, humidity: int>, pop double, "
                  "rain struct<`3h`: double>, weather array<struct<main: string>>")


def shred_forecasts(spark, landing: str):
    """Returns ``(typed rows, quarantined landing rows)``."""
    raw = S.read_csv_landing(spark, landing, ["cod", "city", "list"])
    rows, quarantine = X.json_shred(raw, "list", FORECAST_ENTRY, {
        "id": "id", "dt": "dt", "dt_txt": F.to_timestamp_ntz(F.col("e.dt_txt")),
        "temp": "main.temp", "humidity": "main.humidity", "precip_prob": "pop",
        "rain": F.col("e.rain").getField("3h"), "main": F.col("e.weather")[0]["main"]})
    return rows, quarantine


@query("weather_elt", """
SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS dt, date_trunc('second', ts) AS dt_txt, value AS temp,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity, CAST(0.5 AS DOUBLE) AS precip_prob,
       CASE WHEN event_type = 'purchase' THEN value / 100 END AS rain, event_type AS main,
       true AS dt_consistent
FROM events WHERE event_type <> 'error'
""")
def weather_elt_load(spark, sf):
    landing = scratch_path(spark, "weather_landing")
    land_forecasts(spark, sf, landing)
    rows, _quarantine = shred_forecasts(spark, landing)
    table = f"weather_{uuid.uuid4().hex[:10]}"
    # typed target in another column order than the shredded rows: insert by name
    spark.sql(f"CREATE TABLE {table} (humidity INT, temp DOUBLE, rain DOUBLE, precip_prob DOUBLE, main STRING, "
              f"id BIGINT, dt BIGINT, dt_txt TIMESTAMP_NTZ) USING parquet LOCATION '{scratch_path(spark, table)}'")
    W.insert_by_name(spark, rows, table)
    out = spark.table(table)
    return out.withColumn("dt_consistent", X.from_epoch("dt") == F.col("dt_txt"))


@query("weather_quarantine", "SELECT CAST(user_id AS VARCHAR) AS city FROM events WHERE event_type = 'error'")
def weather_quarantine(spark, sf):
    landing = scratch_path(spark, "weather_landing")
    land_forecasts(spark, sf, landing)
    _rows, quarantine = shred_forecasts(spark, landing)
    return quarantine.select("city")


@query("rates_incremental", """
SELECT event_type AS base, CAST(ts AS DATE) AS last_update, CAST(value AS DOUBLE) AS usd,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(0 AS DOUBLE) AS cad
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
""")
def rates_incremental(spark, sf):
    """The daily load as a trigger-once file stream: two landings (first and second
    half of the month) arrive between runs; a third run finds nothing new."""
    from shoal.streaming import incremental_load

    ev = load(spark, sf, "events")
    root = scratch_path(spark, "rates_stream")
    landing, ckpt = f"{root}/landing", f"{root}/_checkpoint"
    table = f"rates_s_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE TABLE {table} (base STRING, last_update DATE, cad DOUBLE, k DOUBLE, usd DOUBLE) "
              f"USING parquet LOCATION '{root}/table'")

    def lookups(raw):
        return raw.select("base", F.to_date("last_update", "yyyy-MM-dd").alias("last_update"),
                          F.try_element_at("rates", F.lit("USD")).alias("usd"),
                          F.try_element_at("rates", F.lit("k")).alias("k"),
                          F.try_element_at("rates", F.lit("CAD")).alias("cad"), "fetched_at", "seq")

    mid = F.lit("2024-01-16").cast("timestamp_ntz")
    rates = F.map_concat(F.from_json("props", "map<string,double>"), F.create_map(F.lit("USD"), F.col("value")))
    for part in (ev.where(F.col("ts") < mid), ev.where(F.col("ts") >= mid), None):
        if part is not None:
            doc = part.select(F.col("event_type").alias("base"),
                              F.date_format("ts", "yyyy-MM-dd").alias("last_update"), rates.alias("rates"),
                              F.col("ts").alias("fetched_at"), F.col("event_id").alias("seq"))
            W.write_json(doc, f"{landing}/{uuid.uuid4().hex[:8]}", mode="errorifexists")
        incremental_load(spark, landing, RATES_SCHEMA, "json", table, ["base", "last_update"],
                         ["fetched_at", "seq"], ckpt, transform=lookups, fill=["usd", "k", "cad"],
                         options={"recursiveFileLookup": "true"})
    return spark.table(table)


@query("json_dates_to_csv", """
SELECT user_id, value AS x_coordinate, CAST(json_extract_string(props, '$.k') AS INTEGER) AS y_coordinate,
       strftime(ts, '%Y-%m-%d') AS date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events
""")
def json_dates_to_csv(spark, sf):
    """JSON array documents of user events with a text date → strict date parse →
    year / month / day columns → CSV with a header → read back typed."""
    ev = load(spark, sf, "events")
    events = ev.select("user_id", F.col("value").alias("x_coordinate"),
                       F.get_json_object("props", "$.k").cast("int").alias("y_coordinate"),
                       F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_id").alias("_id"))
    root = scratch_path(spark, "json_dates")
    W.write_json_array_documents(events, f"{root}/json", "_id")
    raw = S.read_json_documents(spark, f"{root}/json",
                                "user_id bigint, x_coordinate double, y_coordinate int, date string")
    parts = raw.select("user_id", "x_coordinate", "y_coordinate", "date",
                       *X.date_parts("date", "yyyy-MM-dd", strict=True)[1:])
    W.write_csv(parts, f"{root}/csv")
    return S.read_csv_typed(spark, f"{root}/csv", {"user_id": "bigint", "x_coordinate": "double",
                                                   "y_coordinate": "int", "date": "string", "year": "int",
                                                   "month": "int", "day": "int"})
