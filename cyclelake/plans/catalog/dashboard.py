"""Queries behind the dashboard."""

from __future__ import annotations

from cyclelake.operators import dashboards as d
from cyclelake.plans.checks import sql

CROSSING = """select order_id, min(timestamp_opc) as crossed_at from (select r.order_id, timestamp_opc from s_readings r
  join gold g on r.order_id = g.order_id where sensor_type = 'moisture' and value < target_moisture_ppm
  and timestamp_opc between cycle_start_time and cycle_end_time) group by order_id"""
COLOUR = """case when not coalesce(spec_met, false) or delta_minutes > 0.1::double * standard_cycle_minutes then 'red'
  when delta_minutes > 0 then 'amber' else 'green' end as colour"""


def waste_sql(by):
    return sql(f"""select {by}, count(*) as n_cycles, sum(w) as waste_minutes,
  sum(actual_duration_minutes) as duration_minutes, sum(w) / sum(actual_duration_minutes) as waste_share
  from (select g.*, (epoch_us(cycle_end_time) - epoch_us(crossed_at)) / 6e7 as w from gold g
    join crossing c on g.order_id = c.order_id) group by {by}""", crossing=CROSSING)


def waste(*by):
    return lambda lake: d.drying_waste(lake.gold(), lake.readings(), by, lake.hot_orders())


QUERIES = {
    "filter_cycles": (
        lambda lake: d.filter_cycles(
            lake.gold(), "1996-01-01", "2000-12-31", ["MAT-0007", "MAT-0019", "MAT-0042"], ["kirchheim"], "over standard"
        ),
        sql("""select * from gold where cycle_end_time between timestamp '1996-01-01' and timestamp '2000-12-31'
  and material_id in ('MAT-0007', 'MAT-0019', 'MAT-0042') and plant = 'kirchheim' and delta_minutes > 0"""),
    ),
    "filter_cycles_last_days": (
        lambda lake: d.filter_cycles(lake.gold(), outcome="spec failed", as_of="2001-08-01"),
        sql("""select * from gold where cycle_end_time between timestamp '2001-08-01' - interval '90' day
  and timestamp '2001-08-01' and not spec_met"""),
    ),
    "filter_options": (
        lambda lake: d.filter_options(lake.gold()),
        sql("""select 'material' as kind, material_id as value, max(material_description) as label from gold group by 2
  union all select distinct 'plant', plant, plant from gold"""),
    ),
    "cycle_overview": (
        lambda lake: d.cycle_overview(lake.gold()),
        sql(f"""select order_id, material_description, plant, actual_duration_minutes, standard_cycle_minutes, delta_minutes,
  spec_met, cycle_end_time, {COLOUR} from gold order by cycle_end_time desc, order_id limit 20"""),
    ),
    "cycle_kpis": (
        lambda lake: d.cycle_kpis(lake.gold()),
        sql("""select order_id, actual_duration_minutes, standard_cycle_minutes, delta_minutes,
  100.0::double * delta_minutes / standard_cycle_minutes as delta_pct, "peak_temperature_degC", final_moisture_ppm,
  target_moisture_ppm, final_moisture_ppm - target_moisture_ppm as moisture_margin_ppm, spec_met from gold"""),
    ),
    "cycle_series": (
        lambda lake: d.cycle_series(lake.gold(), lake.readings(), lake.hot_orders()),
        sql("""select r.order_id, timestamp_opc,
  (epoch_us(timestamp_opc) - epoch_us(any_value(cycle_start_time))) / 6e7 as elapsed_minutes,
  max(value) filter (where sensor_type = 'temperature') as temperature,
  max(value) filter (where sensor_type = 'vacuum') as vacuum, max(value) filter (where sensor_type = 'moisture') as moisture,
  any_value(target_moisture_ppm) as target_moisture_ppm, any_value(standard_cycle_minutes) as standard_cycle_minutes
  from s_readings r join gold g on r.order_id = g.order_id group by r.order_id, timestamp_opc"""),
    ),
    "threshold_crossing": (
        lambda lake: d.threshold_crossing(lake.gold(), lake.readings(), lake.hot_orders()),
        sql("""select c.order_id, crossed_at, (epoch_us(crossed_at) - epoch_us(cycle_start_time)) / 6e7 as crossed_after_minutes
  from crossing c join gold g on c.order_id = g.order_id""", crossing=CROSSING),
    ),
    "duration_by_material": (
        lambda lake: d.duration_by_material(lake.gold()),
        sql("""select material_id, max(material_description) as material_description,
  avg(actual_duration_minutes) as avg_actual_minutes, avg(standard_cycle_minutes) as avg_standard_minutes,
  case when avg(actual_duration_minutes) > avg(standard_cycle_minutes) then 'over' else 'green' end as colour
  from gold group by material_id"""),
    ),
    "moisture_vs_duration": (
        lambda lake: d.moisture_vs_duration(lake.gold()),
        sql("""select order_id, material_id, actual_duration_minutes, final_moisture_ppm, target_moisture_ppm, spec_met,
  case when spec_met then 'circle' else 'cross' end as symbol from gold"""),
    ),
    "efficiency_summary": (
        lambda lake: d.efficiency_summary(lake.gold()),
        sql("""select max(material_description) as material_description, material_id, count(*) as cycle_count,
  avg(delta_minutes) as avg_delta_minutes, 100.0::double * count(*) filter (where spec_met) / count(*) as pct_spec_met,
  avg(final_moisture_ppm) as avg_final_moisture from gold group by material_id"""),
    ),
    "long_runners": (
        lambda lake: d.long_runners(lake.gold()),
        sql("""select *, rank() over (order by share_over desc, avg_delta_minutes desc) as position from
  (select material_id, count(*) as n_cycles,
    count(*) filter (where delta_minutes > 0) / count(*)::double as share_over,
    avg(delta_minutes) as avg_delta_minutes from gold group by material_id)"""),
    ),
    "efficiency_trend": (
        lambda lake: _rounded_trend(lake),
        sql("""select period, material_id, n_cycles, round(avg_delta_minutes, 6) as avg_delta_minutes, pct_spec_met,
  round(avg(avg_delta_minutes) over (partition by material_id order by period rows between 3 preceding and current row), 6)
    as moving_avg_delta from (select date_trunc('week', cycle_end_time)::timestamp as period, material_id, count(*) as n_cycles,
    avg(delta_minutes) as avg_delta_minutes, 100.0::double * count(*) filter (where spec_met) / count(*) as pct_spec_met
    from gold group by 1, 2)"""),
    ),
    "drying_waste": (waste("order_id", "material_id", "plant"), waste_sql("order_id, material_id, plant")),
    "drying_waste_by_material": (waste("material_id"), waste_sql("material_id")),
    "drying_waste_by_plant": (waste("plant"), waste_sql("plant")),
    "early_ontime_late": (
        lambda lake: d.early_ontime_late(lake.gold()),
        sql("""select material_id, case when s <= -0.1 then 'early' when abs(s) <= 0.05 then 'on time'
  when s >= 0.1 then 'overrun' else 'between' end as punctuality, count(*) as n_cycles
  from (select material_id, delta_minutes / standard_cycle_minutes as s from gold) group by 1, 2"""),
    ),
}


def _rounded_trend(lake):
    from pyspark.sql import functions as F

    trend = d.efficiency_trend(lake.gold())
    return trend.withColumns({c: F.round(c, 6) for c in ("avg_delta_minutes", "moving_avg_delta")})
