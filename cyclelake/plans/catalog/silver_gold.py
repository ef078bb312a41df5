"""Queries over Silver and Gold."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cyclelake.operators import gold as g
from cyclelake.operators import silver as s
from cyclelake.plans.checks import sql
from cyclelake.schemas import EVENT_PAYLOAD
from cyclelake.session import staging_path
from cyclelake.sources import silver_tables as st


def detail(lake):
    """Header of the cycles out of spec with the size and end of their series."""
    cycles = lake.gold()
    asked = cycles.filter(~F.col("spec_met")).select("order_id")
    header, series = g.cycle_detail(cycles, lake.readings(), asked, lake.hot_orders())
    counts = series.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_readings"), F.max("timestamp_opc").alias("last_reading")
    )
    return header.select("order_id", "plant", "oven_id", "spec_met").join(counts, "order_id", "left")


def touched_gold(lake):
    """Gold of the orders touched by sap_confirmation_failed events only."""
    events = lake.events()
    changed = g.touched_orders(events.filter("event_type = 'sap_confirmation_failed'"))
    return g.gold_incremental(
        changed, events, lake.orders(), lake.materials(), lake.readings(), lake.order_state(),
        hot=lake.hot_orders(),
    )


def over_tables(lake):
    """Silver written once, clustered by order; Gold reads the tables and exchanges none of them."""
    folder = staging_path(lake.spark, "silver")
    names = st.write_silver(lake.spark, folder, f"silver_{uuid.uuid4().hex[:12]}", 8, readings=lake.readings(), events=lake.events(),
                            orders=lake.orders(), order_state=lake.order_state())
    return st.gold_over_tables(lake.spark, names, lake.materials())


EFFICIENCY = """select material_id, max(material_description) as material_description, count(*) as total_cycles,
  avg(actual_duration_minutes) as avg_actual_minutes, avg(standard_cycle_minutes) as avg_standard_minutes,
  avg(delta_minutes) as avg_delta_minutes, count(*) filter (where delta_minutes < 0) as cycles_faster_than_standard,
  count(*) filter (where spec_met) as cycles_meeting_moisture_spec, avg(final_moisture_ppm) as avg_final_moisture_ppm,
  100.0::double * count(*) filter (where spec_met) / count(*) as pct_spec_met from gold group by material_id"""

SQL_TYPE = {"number": "double", "string": "varchar", "int": "integer"}
PAYLOAD = {name: SQL_TYPE[kind] for fields in EVENT_PAYLOAD.values() for name, kind in fields.items()}

QUERIES = {
    "silver_readings": (
        lambda lake: lake.readings(),
        sql("""select reading_id, order_id, oven_id, plant, sensor_type, value, unit, quality, timestamp_opc,
  timestamp_mqtt from s_readings"""),
    ),
    "gold_over_silver_tables": (over_tables, sql("select * from gold")),
    "quality_flag": (
        lambda lake: s.quality_flag(lake.view("br_readings")).select("reading_id", "value", "quality", "timestamp_mqtt", "is_good_quality"),
        sql("select reading_id, value, quality, timestamp_mqtt, quality = 'Good' as is_good_quality from br_readings"),
    ),
    "silver_cycle_events": (
        lambda lake: lake.events(),
        sql("""select event_id, event_type, order_id, oven_id, operator_id, event_time,
  cast(json_extract(payload, '$.setpoint_temperature_degC') as double) as "setpoint_temperature_degC",
  cast(json_extract(payload, '$.setpoint_vacuum_mbar') as double) as setpoint_vacuum_mbar,
  json_extract_string(payload, '$.sap_confirmation_number') as sap_confirmation_number,
  json_extract_string(payload, '$.goods_movement_document') as goods_movement_document,
  json_extract_string(payload, '$.reason') as reason,
  cast(json_extract(payload, '$.elapsed_minutes') as int) as elapsed_minutes,
  cast(json_extract(payload, '$.max_cycle_minutes') as int) as max_cycle_minutes,
  json_extract_string(payload, '$.error_code') as error_code,
  json_extract_string(payload, '$.error_message') as error_message from s_events"""),
    ),
    "event_payload_fields": (
        lambda lake: s.parse_event_payload(lake.view("br_events")).select("event_id", "event_type", "event_time", *PAYLOAD),
        sql("select event_id, event_type, event_time, " + ", ".join(
            f"cast(json_extract_string(payload, '$.{n}') as {k}) as \"{n}\"" for n, k in PAYLOAD.items()) + " from br_events"),
    ),
    "cycle_pairs": (lambda lake: lake.pairs(), sql("select * from s_pairs")),
    "silver_orders": (
        lambda lake: lake.orders().drop("ingested_at"),
        sql("select * exclude (ingested_at) from s_orders"),
    ),
    "silver_materials": (lambda lake: lake.materials(), sql("select * from s_materials")),
    "reading_key_violations": (
        lambda lake: s.key_violations(lake.readings(), ["timestamp_opc", "oven_id", "sensor_type"]),
        sql("""select timestamp_opc, oven_id, sensor_type, count(*) as n_rows from s_readings
  group by all having count(*) > 1"""),
    ),
    "event_key_violations": (
        lambda lake: s.key_violations(lake.events(), ["order_id", "event_type"]),
        sql("select order_id, event_type, count(*) as n_rows from s_events group by all having count(*) > 1"),
    ),
    "utc_timestamps": (
        lambda lake: s.normalise_timestamps(
            lake.view("ad_live").select(
                "reading_id",
                F.concat(
                    F.date_format("timestamp_opc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                    F.when(F.col("quality") == "Bad", "+02:00").when(F.col("plant") == "kirchheim", "Z").otherwise(""),
                ).alias("stamp"),
            ),
            ["stamp"],
        ),
        sql("""select reading_id, case when quality = 'Bad' then timestamp_opc - interval '2' hour else timestamp_opc end
  as stamp from ad_live"""),
    ),
    "cycle_sensor_stats": (lambda lake: g.cycle_sensor_stats(lake.readings()), sql("select * from s_stats")),
    "cycle_sensor_stats_bounded": (
        lambda lake: g.cycle_sensor_stats(lake.readings(), lake.pairs(), lake.hot_orders()),
        sql("""select r.order_id, max(case when sensor_type = 'temperature' then value end) as "peak_temperature_degC",
  min(case when sensor_type = 'vacuum' then value end) as min_vacuum_mbar,
  arg_max(value, case when sensor_type = 'moisture' then struct_pack(t := timestamp_opc, r := reading_id) end)
    as final_moisture_ppm, avg(case when sensor_type = 'moisture' then value end) as avg_moisture_ppm
  from s_readings r join s_pairs p on r.order_id = p.order_id
  where timestamp_opc between cycle_start_time and cycle_end_time group by r.order_id"""),
    ),
    "gold_cycle_summary": (lambda lake: lake.gold(), sql("select * from gold")),
    "gold_incremental": (
        touched_gold,
        sql("""select * from gold where order_id in
  (select order_id from s_events where event_type = 'sap_confirmation_failed')"""),
    ),
    "temperature_limit_tolerance": (
        lambda lake: g.gold_cycle_summary(
            lake.pairs(), lake.orders(), lake.materials(), lake.readings(), tolerance=5.0
        ).groupBy("temperature_limit_met").agg(F.count(F.lit(1)).alias("n_cycles")),
        sql("""select "peak_temperature_degC" <= m."target_temperature_degC" + 5 as temperature_limit_met,
  count(*) as n_cycles from gold g join s_materials m on g.material_id = m.material_id group by 1"""),
    ),
    "cycle_efficiency": (lambda lake: g.v_cycle_efficiency(lake.gold()), sql(EFFICIENCY)),
    "recent_cycles": (
        lambda lake: g.v_recent_cycles(lake.gold()),
        sql("select * from gold order by cycle_end_time desc, order_id limit 20"),
    ),
    "recent_cycles_by_start": (
        lambda lake: g.v_recent_cycles(lake.gold(), 50, "cycle_start_time"),
        sql("select * from gold order by cycle_start_time desc, order_id limit 50"),
    ),
    "cycle_detail": (
        detail,
        sql("""select g.order_id, g.plant, g.oven_id, g.spec_met, n_readings, last_reading from gold g left join
  (select order_id, count(*) as n_readings, max(timestamp_opc) as last_reading from s_readings group by order_id) r
  on g.order_id = r.order_id where not g.spec_met"""),
    ),
}
