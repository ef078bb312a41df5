"""Time-series queries: expected profiles, alerts, estimates, resampling, lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclelake.operators import timeseries as ts
from cyclelake.plans.checks import sql
from cyclelake.session import staging_path

SPEC = """select r.*, "target_temperature_degC" as hot, target_vacuum_mbar as low, target_moisture_ppm as dry,
  m.standard_cycle_minutes as standard, p.cycle_start_time, (epoch_us(timestamp_opc) - epoch_us(cycle_start_time)) / 6e7 as t
  from s_readings r join s_pairs p on r.order_id = p.order_id join s_orders o on o.order_id = r.order_id
  join s_materials m on m.material_id = o.material_id
  where cycle_start_time is not null and timestamp_opc >= cycle_start_time"""
PROFILE = """select *, case sensor_type
  when 'temperature' then case when t <= 60 then 25 + (hot - 25) * (1 - exp(-t / 20)) else hot end
  when 'vacuum' then case when t <= 60 then 1013 else greatest(low + (1013 - low) * exp(-(t - 60) / 10), 0.1) end
  else case when t <= 60 then 5000 else greatest(5000 * exp(ln(dry / 5000.0::double) / standard * (t - 60)), 0) end
  end as expected from spec"""
PROFILE_PARTS = {"spec": SPEC, "profile": PROFILE}


def profile(lake):
    return ts.expected_profile(
        lake.readings(), lake.pairs(), lake.orders(), lake.materials(), hot=lake.hot_orders()
    )


def targets(lake, known=None):
    """``known``: pairs, orders and materials where they have been computed."""
    pairs, orders, materials = known or (lake.pairs(), lake.orders(), lake.materials())
    return pairs.select("order_id", "cycle_start_time", "cycle_end_time").join(
        orders.select("order_id", "material_id"), "order_id"
    ).join(materials.select("material_id", "target_moisture_ppm"), "material_id").drop("material_id")


def oven_setpoints(lake):
    number = F.substring("oven_id", 6, 2).cast("double")
    return lake.view("ad_live").select("oven_id").distinct().select(
        "oven_id", (number + 5).alias("setpoint_vacuum_mbar"), (number * 10).alias("setpoint_temperature_degC")
    )


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Added before rounding, so that short decimals do not sit on a rounding tie.
OFF_TIE = 0.000000012345678

VACUUM = """select *, min(value) over (partition by oven_id order by timestamp_opc, reading_id
  rows between unbounded preceding and 1 preceding) as lowest_before,
  cast(substr(oven_id, 6, 2) as double) + 5 as setpoint_vacuum_mbar from ad_live where sensor_type = 'vacuum'"""
JUMPS = """select *, lag(value) over (partition by oven_id order by timestamp_opc, reading_id) as previous_value,
  cast(substr(oven_id, 6, 2) as double) * 10 as setpoint from ad_live where sensor_type = 'temperature'"""

# Against the last moisture reading at or before the start of the window.
STALLED = """select reading_id, oven_id, value, f.a as window_start, f.v as window_start_value from (
  select r.reading_id, r.oven_id, r.value, max(struct_pack(a := s.timestamp_opc, b := cast(s.reading_id as varchar), v := s.value)) as f
  from ad_live r join ad_live s on s.oven_id = r.oven_id and s.timestamp_opc <= r.timestamp_opc - interval '240' minute
  where r.sensor_type = 'moisture' and s.sensor_type = 'moisture' group by r.reading_id, r.oven_id, r.value)
  where value > f.v * 0.95::double"""

# Moisture in the drying phase: an hour after the start of its cycle until the first value at or below target.
DRYING = """select r.* from ad_live r join ad_cycles c on c.order_id = r.order_id
  left join (select r.order_id, min(r.timestamp_opc) as dry_at from ad_live r join ad_cycles c on c.order_id = r.order_id
    where r.sensor_type = 'moisture' and r.value <= c.target_moisture_ppm
      and r.timestamp_opc > c.cycle_start_time + interval '60' minute group by r.order_id) d on d.order_id = r.order_id
  where r.sensor_type = 'moisture' and r.timestamp_opc > c.cycle_start_time + interval '60' minute
    and (d.dry_at is null or r.timestamp_opc < d.dry_at)"""



def shown_eta(estimates):
    """All cycles, those without an estimate too; instants to the second."""
    return rounded(estimates, "slope", "intercept", "r2", "eta_minutes").withColumn(
        "eta", F.timestamp_seconds(F.round(F.unix_micros("eta") / F.lit(1e6)).cast("bigint")))


ETA = sql("""select order_id, n_readings, round(slope, 6) as slope, round(intercept, 6) as intercept, round(r2, 6) as r2,
  round(minutes, 6) as eta_minutes, to_timestamp(round(epoch_us(cycle_start_time) / 1e6 + minutes * 60))::timestamp as eta
  from (select *, case when slope < -1e-9 then (ln(dry) - intercept) / slope end as minutes from (
    select order_id, count(*) as n_readings, any_value(cycle_start_time) as cycle_start_time,
      case when min(t) < max(t) then regr_slope(ln(value), t) end as slope,
      case when min(t) < max(t) then regr_intercept(ln(value), t) end as intercept,
      case when min(t) < max(t) then regr_r2(ln(value), t) end as r2, any_value(dry) as dry
    from spec where sensor_type = 'moisture' and value > 0 and t > 60
      and order_id not in (select order_id from s_pairs where cycle_end_time is not null) group by order_id))""", **PROFILE_PARTS)


def sketched_lags(lake):
    """Stored sketches of every day, merged: whether each percentile's rank is within two hundredths of what was asked."""
    rows = lake.view("ad_live")
    path = staging_path(lake.spark, "sketches")
    # Two parts per day, as a stream would leave them.
    for part in (0, 1):
        half = rows.filter(F.pmod(F.xxhash64("reading_id"), F.lit(2)) == part)
        ts.lag_sketches(half).write.mode("append").parquet(path)
    asked = {"p50_seconds": 0.5, "p95_seconds": 0.95, "p99_seconds": 0.99}
    found = ts.lag_percentiles(lake.spark.read.parquet(path), first_day="2024-01-05", last_day="2024-01-20")
    exact = rows.filter(F.to_date("timestamp_opc").between(F.lit("2024-01-05"), F.lit("2024-01-20"))).join(F.broadcast(found), "sensor_type")
    lag = (F.unix_micros("timestamp_mqtt") - F.unix_micros("timestamp_opc")) / F.lit(1e6)
    # A value stands for all ranks from the share below it to the share up to it.
    within = [((F.avg((lag < F.col(c)).cast("int")) <= p + 0.02) & (F.avg((lag <= F.col(c)).cast("int")) >= p - 0.02)).alias(c)
              for c, p in asked.items()]
    return exact.groupBy("sensor_type", "n_readings", "max_seconds").agg(*within)


QUERIES = {
    "expected_profile": (
        lambda lake: rounded(profile(lake), "expected_value").select(
            "reading_id", "order_id", "sensor_type", "elapsed_minutes", "expected_value"
        ),
        sql("""select reading_id, order_id, sensor_type, t as elapsed_minutes, round(expected, 6) as expected_value
  from profile""", **PROFILE_PARTS),
    ),
    "profile_residual": (
        lambda lake: rounded(ts.profile_residual(profile(lake)), "residual", "z_score").select(
            "reading_id", "residual", "z_score"
        ),
        sql("""select reading_id, round(value - expected, 6) + 0.0::double as residual, round((value - expected) / case sensor_type
  when 'temperature' then 0.5::double when 'vacuum' then 0.05::double else 10.0::double end, 6) + 0.0::double as z_score from profile""",
            **PROFILE_PARTS),
    ),
    "ewma": (
        lambda lake: ts.ewma(
            lake.view("ad_live"), 0.3, ["oven_id", "sensor_type"], ["timestamp_opc", "timestamp_mqtt", "reading_id"]
        ).select("reading_id", "oven_id", "sensor_type", F.round(F.col("ewma") + F.lit(OFF_TIE), 6).alias("ewma")),
        sql(f"""select a.reading_id, a.oven_id, a.sensor_type, round({OFF_TIE}::double + sum(b.value * pow(0.7::double, a.n - b.n)
    * case when b.n = 1 then 1::double else 0.3::double end), 6) as ewma
  from numbered a join numbered b on a.oven_id = b.oven_id and a.sensor_type = b.sensor_type and b.n between a.n - 130 and a.n
  group by a.reading_id, a.oven_id, a.sensor_type""",
            numbered="""select *, row_number() over (partition by oven_id, sensor_type
    order by timestamp_opc, timestamp_mqtt, reading_id) as n from ad_live"""),
    ),
    "alert_moisture_stalled": (
        lambda lake: ts.alert_moisture_stalled(lake.view("ad_live"), 5.0, 240, ["oven_id"]).select(
            "reading_id", "oven_id", "value", "window_start", "window_start_value"
        ),
        sql(STALLED),
    ),
    "alert_moisture_stalled_drying": (
        lambda lake: ts.alert_moisture_stalled(
            ts.with_phase(lake.view("ad_live"), lake.view("ad_cycles")), 5.0, 240, ["oven_id"]
        ).select("reading_id", "oven_id", "value", "window_start", "window_start_value"),
        sql(STALLED.replace("ad_live", "drying"), drying=DRYING),
    ),
    "alert_temperature_spike": (
        lambda lake: ts.alert_temperature_spike(lake.view("ad_live"), 100.0, ["oven_id"], oven_setpoints(lake)).select(
            "reading_id", "oven_id", "value", "previous_value", "reason"
        ),
        sql("""select reading_id, oven_id, value, previous_value,
  case when abs(value - previous_value) > 100 then 'jump' else 'above setpoint' end as reason from jumps
  where abs(value - previous_value) > 100 or value > setpoint + 2""", jumps=JUMPS),
    ),
    "alert_vacuum_loss": (
        lambda lake: ts.alert_vacuum_loss(lake.view("ad_live"), oven_setpoints(lake), ["oven_id"]).select(
            "reading_id", "oven_id", "value", "lowest_before", "setpoint_vacuum_mbar"
        ),
        sql("""select reading_id, oven_id, value, lowest_before, setpoint_vacuum_mbar from vacuum
  where lowest_before <= setpoint_vacuum_mbar + 0.5 and value > setpoint_vacuum_mbar + 0.5""", vacuum=VACUUM),
    ),
    "cycle_end_eta": (lambda lake: shown_eta(ts.cycle_end_eta(profile(lake), targets(lake))), ETA),
    "lag_percentiles": (
        sketched_lags,
        sql("""select sensor_type, count(*) as n_readings, max((epoch_us(timestamp_mqtt) - epoch_us(timestamp_opc)) / 1e6) as max_seconds,
  true as p50_seconds, true as p95_seconds, true as p99_seconds from ad_live
  where cast(timestamp_opc as date) between date '2024-01-05' and date '2024-01-20' group by 1"""),
    ),
    "simulated_minutes": (
        lambda lake: lake.view("ad_live").select(
            "reading_id",
            ts.simulated_minutes(ts.minutes_between("timestamp_opc", "timestamp_mqtt")).alias("cycle_minutes"),
            ts.wall_minutes(F.col("value")).alias("wall_minutes"),
        ),
        sql("""select reading_id, (epoch_us(timestamp_mqtt) - epoch_us(timestamp_opc)) / 6e7 * 60.0::double as cycle_minutes,
  value / 60.0::double as wall_minutes from ad_live"""),
    ),
    "resample": (
        lambda lake: ts.resample(lake.view("ad_live"), 60),
        sql("""select s.oven_id, s.sensor_type, s.bucket, f.value, coalesce(f.n, 0) as n_readings, f.n is null as is_gap
  from (select oven_id, sensor_type, unnest(generate_series(min(time_bucket(interval '1' hour, timestamp_opc)),
    max(time_bucket(interval '1' hour, timestamp_opc)), interval '1' hour)) as bucket from ad_live group by 1, 2) s
  left join (select oven_id, sensor_type, time_bucket(interval '1' hour, timestamp_opc) as bucket, count(*) as n,
    arg_max(value, struct_pack(a := timestamp_opc, b := reading_id)) as value from ad_live group by 1, 2, 3) f
  on f.oven_id = s.oven_id and f.sensor_type = s.sensor_type and f.bucket = s.bucket"""),
    ),
    "ingest_lag": (
        lambda lake: ts.ingest_lag(lake.view("ad_live")),
        sql("""select sensor_type, count(*) as n_readings, quantile_disc(lag, 0.5) as p50_seconds,
  quantile_disc(lag, 0.95) as p95_seconds, quantile_disc(lag, 0.99) as p99_seconds, max(lag) as max_seconds,
  count(*) filter (where lag > 10) as over_10s, count(*) filter (where lag > 60) as over_60s
  from (select sensor_type, (epoch_us(timestamp_mqtt) - epoch_us(timestamp_opc)) / 1e6 as lag from ad_live) group by 1"""),
    ),
}
