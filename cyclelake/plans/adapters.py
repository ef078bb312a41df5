"""Views that derive oven data from the driver's tables.

The driver's tables hold no oven data, so these views read lineitem as sensor readings, orders as production
orders, part as material versions and events as live readings. The SQL runs unchanged in Spark and in the
checking engine; every view reads its whole tables. Defects (missing starts, copies, illegal changes) follow
natural columns such as priority and price.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events"]

VIEWS = {
    # Every part is one version of the material of its size class; 50 size classes at every scale.
    "br_materials": """
select 'MAT-' || lpad(cast(p_size as string), 4, '0') as material_id, p_name as material_description,
  case p_size % 4 when 0 then 'A' when 1 then 'B' when 2 then 'F' else 'H' end as insulation_class,
  200 + 20 * (p_size % 30) as target_moisture_ppm, 12 * (10 + p_size) as standard_cycle_minutes,
  15 * (10 + p_size) as max_cycle_minutes, cast(100 + p_size as double) as target_temperature_degC,
  cast(1 + p_size % 12 as double) as target_vacuum_mbar, p_retailprice as weight_kg,
  timestamp '2024-01-01 00:00:00' + p_partkey * interval '1' second as updated_at
from part""",
    "ad_orders": """
select 'ORD-' || cast(year(o_orderdate) as string) || '-' || case when o_orderkey < 100000
    then lpad(cast(o_orderkey as string), 5, '0') else cast(o_orderkey as string) end as order_id,
  'MAT-' || lpad(cast(o_orderkey % 50 + 1 as string), 4, '0') as material_id,
  case when o_custkey % 2 = 0 then 'regensburg' else 'kirchheim' end as plant,
  'oven-' || lpad(cast(o_custkey % 20 as string), 2, '0') as oven_id,
  o_orderdate as planned_start, o_orderdate + interval '8' hour as planned_end,
  'OP-' || lpad(cast(o_custkey % 9 as string), 3, '0') as operator_id,
  o_orderdate + (o_custkey % 30) * interval '1' minute as start_ts,
  o_orderdate + ((o_custkey % 30) + (o_orderkey * 7919) % 900 + 60) * interval '1' minute as end_ts,
  case when o_orderstatus = 'F' then 'CONF-' || cast(year(o_orderdate) as string) || '-' || case when o_orderkey < 100000
    then lpad(cast(o_orderkey as string), 5, '0') else cast(o_orderkey as string) end end as sap_confirmation_number,
  o_orderstatus = 'F' and o_orderpriority <> '4-NOT SPECIFIED' as has_movement,
  o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, year(o_orderdate) as order_year
from orders""",
    # Versions of the order: created, released, started (skipped for low priority), then confirmed or aborted.
    "br_orders": """
select order_id, material_id, plant, oven_id, planned_start, planned_end, 480 as standard_cycle_minutes,
  'CREATED' as status, cast(null as string) as operator_id, cast(null as timestamp) as actual_start,
  cast(null as timestamp) as actual_end, cast(null as string) as sap_confirmation_number,
  false as goods_movement_posted, planned_start - interval '2' day as created_at,
  planned_start - interval '2' day as updated_at, planned_start - interval '2' day as ingested_at from ad_orders
union all select order_id, material_id, plant, oven_id, planned_start, planned_end, 480, 'RELEASED', null, null, null,
  null, false, planned_start - interval '2' day, planned_start - interval '1' day, planned_start - interval '1' day
  from ad_orders
union all select order_id, material_id, plant, oven_id, planned_start, planned_end, 480, 'RELEASED', null, null, null,
  null, false, planned_start - interval '2' day, planned_start - interval '1' day, planned_start - interval '23' hour
  from ad_orders where o_orderpriority = '2-HIGH'
union all select order_id, material_id, plant, oven_id, planned_start, planned_end, 480, 'IN_PROGRESS', operator_id,
  start_ts, null, null, false, planned_start - interval '2' day, start_ts, start_ts
  from ad_orders where o_orderpriority <> '5-LOW'
union all select order_id, material_id, plant, oven_id, planned_start, planned_end, 480, 'CONFIRMED', operator_id,
  start_ts, end_ts, sap_confirmation_number, has_movement, planned_start - interval '2' day, end_ts, end_ts
  from ad_orders where o_orderstatus = 'F'
union all select order_id, material_id, plant, oven_id, planned_start, planned_end, 480, 'ABORTED', operator_id,
  start_ts, null, null, false, planned_start - interval '2' day, end_ts, end_ts
  from ad_orders where o_orderstatus = 'P'""",
    # Cheap orders miss their start, urgent ones are delivered twice, medium ones are started twice, some of them after an
    # abort. Some orders have a stray confirmation before their start or a second one after their end.
    "br_events": """
select order_id || '-S' as event_id, 'cycle_started' as event_type, order_id, oven_id, operator_id, start_ts as event_time,
  '{"setpoint_temperature_degC": 120.5, "setpoint_vacuum_mbar": 5}' as payload
  from ad_orders where o_totalprice >= 40000
union all select order_id || '-S', 'cycle_started', order_id, oven_id, operator_id, start_ts,
  '{"setpoint_temperature_degC": 120.5, "setpoint_vacuum_mbar": 5}'
  from ad_orders where o_totalprice >= 40000 and o_orderpriority = '1-URGENT'
union all select order_id || '-R', 'cycle_started', order_id, oven_id, operator_id, start_ts + interval '10' minute,
  '{"setpoint_temperature_degC": 121, "setpoint_vacuum_mbar": 4.5}' from ad_orders where o_orderpriority = '3-MEDIUM'
union all select order_id || '-X', 'cycle_aborted', order_id, oven_id, operator_id, start_ts + interval '5' minute,
  '{"reason": "operator_abort"}' from ad_orders where o_orderpriority = '3-MEDIUM' and o_orderkey % 3 = 0
union all select order_id || '-P', 'cycle_confirmed', order_id, oven_id, operator_id, start_ts - interval '5' minute,
  '{"sap_confirmation_number": "' || sap_confirmation_number || '", "goods_movement_document": "GR-' || order_id || '-P"}'
  from ad_orders where o_orderstatus = 'F' and o_orderkey % 5 = 1
union all select order_id || '-D', 'cycle_confirmed', order_id, oven_id, operator_id, end_ts + interval '30' minute,
  '{"sap_confirmation_number": "' || sap_confirmation_number || '", "goods_movement_document": "GR-' || order_id || '-D"}'
  from ad_orders where o_orderstatus = 'F' and o_orderkey % 5 = 2
union all select order_id || '-F', 'sap_confirmation_failed', order_id, oven_id, operator_id, end_ts - interval '5' minute,
  '{"error_code": "ORDER_LOCKED", "error_message": "locked by another user"}'
  from ad_orders where o_orderstatus = 'F' and o_orderpriority = '2-HIGH'
union all select order_id || '-C', 'cycle_confirmed', order_id, oven_id, operator_id, end_ts,
  '{"sap_confirmation_number": "' || sap_confirmation_number || '", "goods_movement_document": "GR-' || order_id || '"}'
  from ad_orders where o_orderstatus = 'F'
union all select order_id || '-A', 'cycle_aborted', order_id, oven_id, operator_id, end_ts, '{"reason": "operator_abort"}'
  from ad_orders where o_orderstatus = 'P' and o_orderpriority < '3'
union all select order_id || '-T', 'cycle_timeout', order_id, oven_id, cast(null as string), end_ts,
  '{"elapsed_minutes": 700, "max_cycle_minutes": 600}'
  from ad_orders where o_orderstatus = 'P' and o_orderpriority >= '3'""",
    # Extensions of running cycles: some in time, some long after the deadline, some orders have two.
    "br_extensions": """
select order_id || '-E1' as extension_id, order_id, start_ts + (100 + o_orderkey % 300) * interval '1' minute as extended_at,
  120 + o_orderkey % 240 as minutes from ad_orders where o_orderkey % 4 = 0
union all select order_id || '-E2', order_id, start_ts + (900 + o_orderkey % 500) * interval '1' minute, 300
  from ad_orders where o_orderkey % 6 = 0""",
    # Order-stamped readings with copies of the same reading_id and bad quality.
    "br_readings": """
select l_orderkey * 10 + l_linenumber as reading_id, order_id, oven_id, plant,
  case l_linenumber % 3 when 0 then 'temperature' when 1 then 'vacuum' else 'moisture' end as sensor_type,
  case l_linenumber % 3 when 0 then l_quantity * 3 when 1 then l_quantity else l_quantity * 20 end as value,
  case l_linenumber % 3 when 0 then 'degC' when 1 then 'mbar' else 'ppm' end as unit,
  case when l_returnflag = 'R' then 'Bad' when l_tax = 0 then 'Uncertain' else 'Good' end as quality,
  planned_start + (l_partkey % 700) * interval '1' minute as timestamp_opc,
  planned_start + (l_partkey % 700) * interval '1' minute + (l_suppkey % 90) * interval '1' second as timestamp_mqtt
from lineitem join ad_orders on l_orderkey = o_orderkey""",
    # Live readings per oven: blocks of events share an order, every third block is idle.
    "ad_live": """
select event_id as reading_id, 'oven-' || lpad(cast(user_id % 20 as string), 2, '0') as oven_id,
  case when user_id % 2 = 0 then 'regensburg' else 'kirchheim' end as plant, ts as timestamp_opc,
  ts + (event_id % 17) * interval '1' second as timestamp_mqtt,
  case event_type when 'error' then 'moisture' when 'purchase' then 'vacuum' when 'signup' then 'vacuum'
    else 'temperature' end as sensor_type, value,
  case event_type when 'error' then 'ppm' when 'purchase' then 'mbar' when 'signup' then 'mbar' else 'degC' end as unit,
  case when event_id % 2300 between 100 and 399 then 'Bad' when event_id % 29 = 0 then 'Uncertain' else 'Good' end as quality,
  case when (event_id - event_id % 500) % 1500 = 0 then null
    else cast(event_id - event_id % 500 as string) || '-' || cast(user_id % 20 as string) end as order_id
from events""",
    # Cycles of the live orders, some of which get dry.
    "ad_cycles": """
select order_id, min(timestamp_opc) as cycle_start_time, 1 + cast(min(reading_id) % 8 as int) as target_moisture_ppm
from ad_live where order_id is not null group by order_id""",
    "br_movements": """
select 'GR-' || cast(order_year as string) || '-' || case when o_orderkey < 1000000
    then lpad(cast(o_orderkey as string), 6, '0') else cast(o_orderkey as string) end as document_number,
  order_id, material_id, 'GR_PRODUCTION' as movement_type, cast(1 as double) as quantity, 'EA' as unit,
  cast(end_ts as date) as posting_date, 'WH-01' as storage_location, end_ts as posted_at
from ad_orders where has_movement
union all select 'GR-' || cast(order_year as string) || '-' || case when o_orderkey < 1000000
    then lpad(cast(o_orderkey as string), 6, '0') else cast(o_orderkey as string) end, order_id || 'X', material_id,
  'GR_PRODUCTION', cast(1 as double), 'EA', cast(end_ts as date), 'WH-02', end_ts
from ad_orders where o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM'""",
    # Confirmations: repeated for urgent orders, for aborted orders, and for orders nobody knows.
    "br_confirmations": """
select order_id, order_id || '-OPR-010' as operation_id, cast(1 as double) as confirmed_quantity,
  start_ts as actual_start, end_ts as actual_end, operator_id, cast(o_orderkey % 900 as double) as final_moisture_ppm,
  o_orderkey % 900 < 400 as spec_met, end_ts as posted_at, sap_confirmation_number
from ad_orders where o_orderstatus = 'F'
union all select order_id, order_id || '-OPR-010', cast(1 as double), start_ts, end_ts + interval '10' minute, operator_id,
  cast(o_orderkey % 900 as double), o_orderkey % 900 < 400, end_ts + interval '10' minute, sap_confirmation_number
from ad_orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'
union all select order_id, order_id || '-OPR-010', cast(1 as double), start_ts, end_ts, operator_id,
  cast(o_orderkey % 900 as double), false, end_ts + interval '1' minute, cast(null as string)
from ad_orders where o_orderstatus = 'P' and o_orderpriority = '1-URGENT'
union all select order_id || 'X', order_id || 'X-OPR-010', cast(1 as double), start_ts, end_ts, operator_id,
  cast(o_orderkey % 900 as double), true, end_ts, cast(null as string)
from ad_orders where o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM'""",
    # Messages as JSON text; some carry a defect chosen by their number.
    "m_readings": """
select event_id, plant, oven_id, sensor_type, 'factory/' || case when event_id % 53 = 0 then 'kirchheim' else plant end
  || '/' || oven_id || '/' || sensor_type as topic, timestamp_opc, timestamp_mqtt, case event_id % 41 when 0 then 'not json'
  when 1 then '["a", 1]' else '{"reading_id": "' || substr(h, 1, 8) || '-' || substr(h, 9, 4)
  || case event_id % 41 when 9 then '-1' else '-4' end || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12)
  || '", "order_id": ' || case event_id % 41 when 14 then '7' else coalesce('"' || order_id || '"', 'null') end
  || ', "oven_id": "' || case event_id % 41 when 8 then 'oven-1' else oven_id end
  || '", "plant": "' || case event_id % 41 when 13 then 'paris' else plant end
  || '", "sensor_type": "' || sensor_type || '"' || case event_id % 41 when 2 then '' else ', "value": '
    || case event_id % 41 when 3 then '"abc"' when 4 then '"1.5"' when 5 then 'true' when 6 then 'NaN'
      else cast(value as string) end end
  || ', "unit": "' || case event_id % 41 when 7 then 'bar' when 15 then 'ppm' else unit end
  || '", "quality": ' || case event_id % 41 when 12 then 'null' else '"' || quality || '"' end
  || ', "timestamp_opc": "' || replace(cast(date_trunc('second', timestamp_opc) as string), ' ', 'T')
  || case event_id % 41 when 11 then '+02:00' else 'Z' end
  || '", "timestamp_mqtt": "' || replace(cast(date_trunc('second', timestamp_mqtt) as string), ' ', 'T') || 'Z"'
  || case event_id % 41 when 10 then ', "_meta": {"a": 1}' else '' end || '}' end as raw_payload
from (select reading_id as event_id, md5(cast(reading_id as string)) as h, plant, oven_id, sensor_type, value, unit, quality,
  order_id, timestamp_opc, timestamp_mqtt from ad_live) numbered""",
    "m_states": """
select reading_id as event_id, '{"oven_id": ' || case reading_id % 31 when 1 then '5' else '"' || oven_id || '"' end
  || ', "order_id": ' || case reading_id % 31 when 2 then '"ORD-1"' when 3 then 'null' else '"ORD-2031-07315"' end
  || ', "status": "' || case reading_id % 31 when 4 then 'fault' when 3 then 'idle' else 'running' end
  || '", "temperature_degC": ' || case reading_id % 31 when 5 then '"hot"' when 3 then 'null' else cast(value as string) end
  || ', "moisture_ppm": ' || case reading_id % 31 when 6 then 'false' else '12' end
  || ', "cycle_elapsed_minutes": ' || case reading_id % 31 when 7 then '-1' else '3.5' end
  || ', "moisture_threshold_met": ' || case reading_id % 31 when 8 then '1' when 9 then 'null' else 'true' end
  || ', "timestamp": "2031-11-19T04:17:50' || case reading_id % 31 when 10 then '' else '.5Z' end || '"}' as raw_payload
from ad_live""",
    "m_answers": """
select o_orderkey, '{"order_id": "' || order_id || '", "count": ' || case o_orderkey % 29 when 1 then '"2"' when 2 then '-1'
    when 3 then '3' when 4 then '1.0' when 5 then '1' else '2' end
  || case o_orderkey % 29 when 6 then '' when 7 then ', "readings": {}' else ', "readings": [{"reading_id": "'
    || case o_orderkey % 29 when 8 then 'x' else '00000000-0000-4000-8000-000000000001' end
    || '", "timestamp_opc": "2031-11-19T03:25:00Z", "sensor_type": "temperature", "value": '
    || case o_orderkey % 29 when 9 then 'null' else '64.4' end || ', "unit": "degC", "quality": "Good"}'
    || case o_orderkey % 29 when 5 then '' when 10 then ', 17' else ', {"reading_id": "00000000-0000-4000-8000-000000000002", '
    || '"timestamp_opc": "2031-11-19T03:40:00Z", "sensor_type": "moisture", "value": 7, "unit": "'
    || case o_orderkey % 29 when 11 then 'pct' else 'ppm' end || '", "quality": "Bad"}' end || ']' end || '}' as raw_payload
from ad_orders""",
    "m_order_states": """
select o_orderkey, '{"order_id": "' || order_id || '", "status": "' || case o_orderkey % 23 when 1 then 'CLOSED'
    when 2 then 'in-progress' else 'closed' end || '", "operator_id": ' || case o_orderkey % 23 when 3 then '7'
    when 4 then 'null' else '"' || operator_id || '"' end || ', "cycle_confirmed_at": ' || case o_orderkey % 23
    when 5 then '"yesterday"' when 4 then 'null' else '"2031-11-19T11:06:00Z"' end
  || case o_orderkey % 23 when 6 then '' when 7 then ', "quality_check_passed": "yes"' else
    ', "quality_check_passed": true' end || '}' as raw_payload
from ad_orders""",
    "m_confirmations": """
select o_orderkey, '{"order_id": "' || order_id || '"' || case o_orderkey % 19 when 1 then '' else
    ', "sap_confirmation_number": "' || case o_orderkey % 19 when 2 then 'C-1' else 'CONF-2031-55102' end || '"' end
  || ', "status": ' || case o_orderkey % 19 when 3 then 'null' when 4 then '"OPEN"' else '"CONFIRMED"' end
  || ', "posted_at": "' || replace(cast(end_ts as string), ' ', 'T') || case o_orderkey % 19 when 5 then '' else 'Z' end
  || '"}' as raw_payload
from ad_orders""",
    "m_orders": """
select o_orderkey, '{"order_id": "' || order_id || '", "material_id": "' || material_id || '", "plant": "' || plant
  || '", "oven_id": "' || case o_orderkey % 37 when 1 then 'OVEN-01' else oven_id end
  || '", "planned_start": "' || replace(cast(planned_start as string), ' ', 'T') || 'Z", "planned_end": '
  || case o_orderkey % 37 when 2 then 'null' else '"' || replace(cast(planned_end as string), ' ', 'T') || 'Z"' end
  || ', "standard_cycle_minutes": ' || case o_orderkey % 37 when 3 then '0' when 4 then '480.5' when 5 then 'true' else '480' end
  || ', "status": "' || case o_orderkey % 37 when 6 then 'RUNNING' else 'RELEASED' end
  || '", "operator_id": ' || case o_orderkey % 37 when 7 then '3' else 'null' end
  || case o_orderkey % 37 when 8 then '' else ', "actual_start": null' end || ', "actual_end": '
  || case o_orderkey % 37 when 9 then '"soon"' else '"' || replace(cast(end_ts as string), ' ', 'T') || 'Z"' end
  || ', "sap_confirmation_number": null, "goods_movement_posted": ' || case o_orderkey % 37 when 10 then '"no"' else 'false' end
  || ', "created_at": "2031-11-17T15:20:00Z", "updated_at": "2031-11-17T15:20:00Z"}' as raw_payload
from ad_orders""",
    "m_materials": """
select p_partkey, '{"material_id": "MAT-' || lpad(cast(p_size as string), 4, '0') || '", "material_description": "'
  || case p_partkey % 29 when 1 then '' else p_name end || '", "insulation_class": "' || case p_partkey % 29 when 2 then 'C'
    else 'H' end || '", "target_moisture_ppm": ' || case p_partkey % 29 when 3 then '300.5' else '300' end
  || case p_partkey % 29 when 4 then '' else ', "standard_cycle_minutes": ' || cast(10 * p_size as string) end
  || case p_partkey % 29 when 5 then '' when 4 then '' else ', "max_cycle_minutes": ' || case p_partkey % 29 when 6
    then 'null' when 7 then cast(10 * p_size as string) else cast(12 * p_size as string) end end
  || ', "target_temperature_degC": ' || case p_partkey % 29 when 8 then '-1.5' else '130.0' end
  || ', "target_vacuum_mbar": ' || case p_partkey % 29 when 9 then '"5"' else '5' end
  || ', "weight_kg": ' || case p_partkey % 29 when 10 then 'true' else cast(p_retailprice as string) end
  || ', "updated_at": "2031-11-16T09:10:00Z"}' as raw_payload
from part""",
    "m_movements": """
select o_orderkey, '{"document_number": "GR-2031-' || case o_orderkey % 23 when 1 then '12' else '700412' end
  || '", "order_id": "' || order_id || '", "material_id": "' || material_id || '", "movement_type": "'
  || case o_orderkey % 23 when 2 then 'GI' else 'GR_PRODUCTION' end || '", "quantity": '
  || case o_orderkey % 23 when 3 then '0' when 4 then '"1"' when 5 then '1.5' else '1' end
  || ', "unit": "' || case o_orderkey % 23 when 6 then '' else 'EA' end || '", "posting_date": "'
  || case o_orderkey % 23 when 7 then '19.11.2031' else '2031-11-19' end || '"' || case o_orderkey % 23 when 8 then ''
    else ', "storage_location": "WH-01"' end || ', "posted_at": "2031-11-19T16:41:09Z", "status": "'
  || case o_orderkey % 23 when 9 then 'draft' else 'posted' end || '"}' as raw_payload
from ad_orders""",
    "m_events": """
select o_orderkey, '{"event_id": "00000000-0000-' || case o_orderkey % 43 when 1 then '5' else '4' end
  || '000-9000-000000000001", "event_type": "' || event_type || '", "order_id": "' || order_id || '", "oven_id": "'
  || oven_id || '", "operator_id": ' || case o_orderkey % 43 when 2 then 'null' when 3 then '[]' else '"' || operator_id || '"' end
  || ', "timestamp": "' || replace(cast(start_ts as string), ' ', 'T') || 'Z"' || case o_orderkey % 43 when 4 then ''
    when 5 then ', "payload": null' when 6 then ', "payload": "text"' when 7 then ', "payload": {}' else ', "payload": '
    || case event_type when 'cycle_started' then '{"setpoint_temperature_degC": ' || case o_orderkey % 43 when 8 then '"a"'
        when 9 then 'true' else '130' end || ', "setpoint_vacuum_mbar": 5.5}'
      when 'cycle_confirmed' then '{"sap_confirmation_number": ' || case o_orderkey % 43 when 8 then '5' else '"CONF"' end
        || ', "goods_movement_document": "GR"}'
      when 'cycle_aborted' then '{"reason": ' || case o_orderkey % 43 when 8 then 'null' else '"stop"' end || '}'
      when 'cycle_timeout' then '{"elapsed_minutes": ' || case o_orderkey % 43 when 8 then '1.5' else '700' end
        || ', "max_cycle_minutes": 600}'
      else '{"error_code": "E1", "error_message": "text"}' end end || '}' as raw_payload
from (select *, case o_orderkey % 6 when 0 then 'cycle_started' when 1 then 'cycle_confirmed' when 2 then 'cycle_aborted'
  when 3 then 'cycle_timeout' when 4 then 'sap_confirmation_failed' else 'order_started' end as event_type from ad_orders) typed""",
    "m_gold": """
select o_orderkey, '{"order_id": "' || order_id || '", "material_id": "' || material_id || '", "material_description": '
  || case o_orderkey % 31 when 1 then 'null' else '"unit"' end || ', "plant": "' || plant || '", "oven_id": "' || oven_id
  || '", "cycle_start_time": "' || replace(cast(start_ts as string), ' ', 'T') || case o_orderkey % 31 when 2 then '' else 'Z' end
  || '", "cycle_end_time": "' || replace(cast(end_ts as string), ' ', 'T') || 'Z", "actual_duration_minutes": '
  || case o_orderkey % 31 when 3 then '"500"' when 4 then '500.5' else '500' end || ', "standard_cycle_minutes": 480'
  || ', "delta_minutes": ' || case o_orderkey % 31 when 5 then '25' when 4 then '20.5' else '20' end
  || ', "peak_temperature_degC": 109.8, "min_vacuum_mbar": 5' || case o_orderkey % 31 when 6 then '' else
    ', "final_moisture_ppm": ' || cast(o_orderkey % 500 as string) end || ', "target_moisture_ppm": '
  || case o_orderkey % 31 when 7 then '300.5' else '300' end || ', "spec_met": ' || case o_orderkey % 31 when 8 then 'true'
    when 9 then '1' else case when o_orderkey % 500 < 300 then 'true' else 'false' end end
  || ', "sap_confirmation_number": ' || coalesce('"' || sap_confirmation_number || '"', 'null')
  || ', "goods_movement_posted": ' || case when has_movement then 'true' else 'false' end || '}' as raw_payload
from ad_orders""",
    "order_state": """
select order_id, lower(case when o_orderstatus = 'F' then 'closed' else 'in-progress' end) as status, operator_id,
  case when o_orderstatus = 'F' then o_totalprice >= 100000 end as quality_check_passed from ad_orders""",
}


def table(spark: SparkSession, sf_dir: str, name: str, live: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not live:
        return df
    return spark.readStream.schema(df.schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _needed(sql: str) -> list[str]:
    return [n for n in [*VIEWS, *TABLES] if re.search(rf"\b(?:from|join)\s+{n}\b", sql)]


def view(spark: SparkSession, sf_dir: str, name: str, live=()) -> DataFrame:
    """One adapter view as a DataFrame with timestamps as UTC instants. Tables named in ``live`` are read as
    streams."""
    if name in TABLES:
        return table(spark, sf_dir, name, name in live)
    sql = VIEWS[name]
    for n in _needed(sql):
        view(spark, sf_dir, n, live).createOrReplaceTempView(f"src_{n}")
        sql = re.sub(rf"\b(from|join)\s+{n}\b", rf"\1 src_{n}", sql)
    df = spark.sql(sql)
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(casts) if casts else df


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking engine returns them."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df
