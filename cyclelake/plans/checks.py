"""Reference SQL for the catalogue: shared subqueries over the adapter views, assembled on demand."""

from __future__ import annotations

import re

from cyclelake.plans.adapters import VIEWS

SHARED = {
    "s_readings": """select * from br_readings where quality = 'Good'
  qualify row_number() over (partition by reading_id order by timestamp_mqtt, timestamp_opc, value) = 1""",
    "s_events": "select * from br_events qualify row_number() over (partition by event_id order by event_time, event_type) = 1",
    "s_pairs": """select order_id, min(case when event_type = 'cycle_started' then event_time end) as cycle_start_time,
  max(case when event_type = 'cycle_confirmed' then event_time end) as cycle_end_time,
  max(case when event_type = 'cycle_confirmed' then operator_id end) as operator_id,
  max(case when event_type = 'cycle_confirmed' then json_extract_string(payload, '$.sap_confirmation_number') end)
    as sap_confirmation_number
  from s_events where event_type in ('cycle_started', 'cycle_confirmed') group by order_id""",
    "s_orders": """select * from br_orders
  qualify row_number() over (partition by order_id order by updated_at desc, ingested_at desc) = 1""",
    "s_materials": """select * from br_materials
  qualify row_number() over (partition by material_id order by updated_at desc) = 1""",
    "s_stats": """select order_id, max(case when sensor_type = 'temperature' then value end) as "peak_temperature_degC",
  min(case when sensor_type = 'vacuum' then value end) as min_vacuum_mbar,
  arg_max(value, case when sensor_type = 'moisture' then struct_pack(t := timestamp_opc, r := reading_id) end)
    as final_moisture_ppm,
  avg(case when sensor_type = 'moisture' then value end) as avg_moisture_ppm
  from s_readings where order_id is not null group by order_id""",
    "gold": """select p.order_id, o.material_id, m.material_description, o.plant, o.oven_id, p.cycle_start_time,
  p.cycle_end_time, (epoch_us(p.cycle_end_time) - epoch_us(p.cycle_start_time)) / 6e7 as actual_duration_minutes,
  m.standard_cycle_minutes,
  (epoch_us(p.cycle_end_time) - epoch_us(p.cycle_start_time)) / 6e7 - m.standard_cycle_minutes as delta_minutes,
  s."peak_temperature_degC", s.min_vacuum_mbar, s.final_moisture_ppm, s.avg_moisture_ppm, m.target_moisture_ppm,
  s.final_moisture_ppm < m.target_moisture_ppm as spec_met,
  s."peak_temperature_degC" <= m."target_temperature_degC" as temperature_limit_met, q.quality_check_passed,
  coalesce(p.operator_id, o.operator_id) as operator_id,
  coalesce(p.sap_confirmation_number, o.sap_confirmation_number) as sap_confirmation_number, o.goods_movement_posted
  from s_pairs p join s_orders o on p.order_id = o.order_id join s_materials m on o.material_id = m.material_id
  left join s_stats s on s.order_id = p.order_id left join order_state q on q.order_id = p.order_id
  where p.cycle_end_time >= p.cycle_start_time""",
}


def sql(body: str, **extra: str) -> str:
    """``body`` with the subqueries it uses in front, in dependency order."""
    known = {**VIEWS, **SHARED, **extra}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({known[n].strip()})" for n in ordered) + "\n" + body
