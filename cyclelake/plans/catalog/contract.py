"""Contract checks over message texts derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclelake.operators import contracts as c
from cyclelake.plans.checks import sql

KINDS = {
    "string": "= 'VARCHAR'", "bool": "= 'BOOLEAN'", "int": "in ('BIGINT', 'UBIGINT')", "array": "= 'ARRAY'",
    "number": "in ('BIGINT', 'UBIGINT', 'DOUBLE')", "object": "= 'OBJECT'",
}


def kind(field, j="j"):
    return f"coalesce(json_type({j}, '$.{field}'), 'NULL')"


def text(field, j="j"):
    return f"json_extract_string({j}, '$.{field}')"


def number(field):
    return f"try_cast({text(field)} as double)"


def broken(condition, message):
    return f"case when {condition} then '{message}' end"


def matches(field, pattern, label, nullable=False, j="j"):
    good = f"({kind(field, j)} = 'VARCHAR' and regexp_matches({text(field, j)}, '{pattern}'))"
    if nullable:
        return broken(f"not ({kind(field, j)} = 'NULL' or {good})", f"{field}: must be {label} or null")
    return broken(f"not {good}", f"{field}: must be {label}")


def one_of(field, values, j="j"):
    listed = ", ".join(f"'{v}'" for v in values)
    good = f"({kind(field, j)} = 'VARCHAR' and {text(field, j)} in ({listed}))"
    return broken(f"not {good}", f"{field}: must be one of {', '.join(values)}")


def typed(field, name, nullable=False, j="j"):
    good = f"{kind(field, j)} {KINDS[name]}"
    if nullable:
        return broken(f"not ({kind(field, j)} = 'NULL' or {good})", f"{field}: must be {name} or null")
    return broken(f"not ({good})", f"{field}: must be {name}")


def positive(field, name):
    return broken(f"not ({kind(field)} {KINDS[name]} and {number(field)} > 0)", f"{field}: must be positive {name}")


def filled(field):
    return broken(f"not ({kind(field)} = 'VARCHAR' and length({text(field)}) > 0)", f"{field}: must be non-empty string")


def required(*fields):
    return [broken(f"json_type(j, '$.{f}') is null", f"{f}: required") for f in fields]


UUID4, OVEN, ORDER, MATERIAL = c.UUID4, c.OVEN, c.ORDER_ID, c.MATERIAL_ID
UTC = (c.ISO_UTC, "ISO 8601 UTC")
PLANTS = ["regensburg", "kirchheim"]
SENSORS = ["temperature", "vacuum", "moisture"]


def checked(view, key, rules, more="[]"):
    """Reference SQL: the list of broken rules per message."""
    return f"""select {key}, raw_payload, case when j is null then ['payload: not valid JSON']
    when json_type(j) <> 'OBJECT' then ['payload: must be object']
    else list_concat(list_filter([{', '.join(rules)}], lambda x: x is not null), {more}) end as errors
  from (select *, case when json_valid(raw_payload) and not contains(raw_payload, 'NaN') then raw_payload::json end as j
    from {view})"""


RULES = {
    "C1": ("m_readings", "event_id", [
        matches("reading_id", UUID4, "UUID v4"), typed("order_id", "string", True), matches("oven_id", OVEN, "oven-NN"),
        one_of("plant", PLANTS), one_of("sensor_type", SENSORS), typed("value", "number"),
        one_of("unit", ["degC", "mbar", "ppm"]),
        broken(f"""{text('unit')} in ('degC', 'mbar', 'ppm') and {text('unit')} <> case {text('sensor_type')}
          when 'temperature' then 'degC' when 'vacuum' then 'mbar' when 'moisture' then 'ppm' end""",
               "unit: does not fit sensor_type"),
        one_of("quality", ["Good", "Bad", "Uncertain"]), matches("timestamp_opc", *UTC), matches("timestamp_mqtt", *UTC),
    ], """case when len(list_filter(json_keys(j), lambda k: k not in ('reading_id', 'order_id', 'oven_id', 'plant', 'sensor_type',
      'value', 'unit', 'quality', 'timestamp_opc', 'timestamp_mqtt'))) > 0 then ['unexpected fields: ' || array_to_string(
      list_sort(list_filter(json_keys(j), lambda k: k not in ('reading_id', 'order_id', 'oven_id', 'plant', 'sensor_type',
      'value', 'unit', 'quality', 'timestamp_opc', 'timestamp_mqtt'))), ', ')] else [] end"""),
    "C2": ("m_states", "event_id", [
        matches("oven_id", OVEN, "oven-NN"), matches("order_id", ORDER, "ORD-YYYY-NNNNN", True),
        one_of("status", ["idle", "running", "cycle_complete", "timeout"]),
        *[typed(f, "number", True) for f in ("temperature_degC", "vacuum_mbar", "moisture_ppm", "cycle_elapsed_minutes")],
        broken(f"{kind('cycle_elapsed_minutes')} {KINDS['number']} and {number('cycle_elapsed_minutes')} < 0",
               "cycle_elapsed_minutes: must be >= 0"),
        typed("moisture_threshold_met", "bool", True), matches("timestamp", *UTC),
    ], "[]"),
    "C3": ("m_answers", "o_orderkey", [
        matches("order_id", ORDER, "ORD-YYYY-NNNNN"),
        broken(f"not ({kind('count')} {KINDS['int']}) or {number('count')} < 0", "count: must be non-negative int"),
        typed("readings", "array"),
        broken(f"""{kind('count')} {KINDS['int']} and {kind('readings')} = 'ARRAY'
          and {number('count')} <> json_array_length(j, '$.readings')""", "count: does not match readings"),
    ], """case when coalesce(json_type(j, '$.readings'), '') = 'ARRAY' then flatten(list_transform(
      range(cast(json_array_length(j, '$.readings') as bigint)), lambda i: case when json_type(j, '$.readings[' || i || ']') <> 'OBJECT'
      then ['readings[' || i || ']: must be object'] else list_filter([%s], lambda x: x is not null) end)) else [] end""" % ", ".join(
        f"'readings[' || i || '].' || {r}" for r in [
            matches("reading_id", UUID4, "UUID v4", j="json_extract(j, '$.readings[' || i || ']')"),
            matches("timestamp_opc", *UTC, j="json_extract(j, '$.readings[' || i || ']')"),
            one_of("sensor_type", SENSORS, j="json_extract(j, '$.readings[' || i || ']')"),
            typed("value", "number", j="json_extract(j, '$.readings[' || i || ']')"),
            one_of("unit", ["degC", "mbar", "ppm"], j="json_extract(j, '$.readings[' || i || ']')"),
            one_of("quality", ["Good", "Bad", "Uncertain"], j="json_extract(j, '$.readings[' || i || ']')"),
        ])),
    "C4": ("m_order_states", "o_orderkey", [
        matches("order_id", ORDER, "ORD-YYYY-NNNNN"), one_of("status", ["released", "in-progress", "confirmed", "closed"]),
        typed("operator_id", "string", True), matches("cycle_confirmed_at", *UTC, nullable=True),
        typed("quality_check_passed", "bool", True),
    ], "[]"),
    "C5": ("m_confirmations", "o_orderkey", [
        *required("order_id", "sap_confirmation_number", "status", "posted_at"), matches("order_id", ORDER, "ORD-YYYY-NNNNN"),
        matches("sap_confirmation_number", c.CONFIRMATION_NUMBER, "CONF-YYYY-NNNNN"), one_of("status", ["CONFIRMED"]),
        matches("posted_at", *UTC),
    ], "[]"),
    "C6": ("m_orders", "o_orderkey", [
        *required("order_id", "material_id", "plant", "oven_id", "planned_start", "planned_end", "standard_cycle_minutes",
                  "status", "operator_id", "actual_start", "actual_end", "sap_confirmation_number", "goods_movement_posted",
                  "created_at", "updated_at"),
        matches("order_id", ORDER, "ORD-YYYY-NNNNN"), matches("material_id", MATERIAL, "MAT-NNNN"), one_of("plant", PLANTS),
        matches("oven_id", OVEN, "oven-NN"),
        *[matches(f, *UTC) for f in ("planned_start", "planned_end", "created_at", "updated_at")],
        *[matches(f, *UTC, nullable=True) for f in ("actual_start", "actual_end")],
        one_of("status", ["CREATED", "RELEASED", "IN_PROGRESS", "CONFIRMED", "ABORTED", "CLOSED"]),
        positive("standard_cycle_minutes", "int"), typed("goods_movement_posted", "bool"),
        typed("operator_id", "string", True), typed("sap_confirmation_number", "string", True),
    ], "[]"),
    "C7": ("m_materials", "p_partkey", [
        *required("material_id", "material_description", "insulation_class", "target_moisture_ppm", "standard_cycle_minutes",
                  "max_cycle_minutes", "target_temperature_degC", "target_vacuum_mbar", "weight_kg", "updated_at"),
        matches("material_id", MATERIAL, "MAT-NNNN"), filled("material_description"),
        one_of("insulation_class", ["A", "B", "F", "H"]),
        *[positive(f, "int") for f in ("target_moisture_ppm", "standard_cycle_minutes", "max_cycle_minutes")],
        broken("""(json_type(j, '$.max_cycle_minutes') is null or json_type(j, '$.max_cycle_minutes') <> 'NULL')
          and coalesce(try_cast(json_extract_string(j, '$.max_cycle_minutes') as double), 0)
            <= coalesce(try_cast(json_extract_string(j, '$.standard_cycle_minutes') as double), 0)""",
               "max_cycle_minutes: must be > standard_cycle_minutes"),
        *[positive(f, "number") for f in ("target_temperature_degC", "target_vacuum_mbar", "weight_kg")],
        matches("updated_at", *UTC),
    ], "[]"),
    "C8": ("m_movements", "o_orderkey", [
        *required("document_number", "order_id", "material_id", "movement_type", "quantity", "unit", "posting_date",
                  "storage_location", "posted_at", "status"),
        matches("document_number", c.MOVEMENT_NUMBER, "GR-YYYY-NNNNNN"), matches("order_id", ORDER, "ORD-YYYY-NNNNN"),
        matches("material_id", MATERIAL, "MAT-NNNN"), one_of("movement_type", ["GR_PRODUCTION"]),
        positive("quantity", "number"), filled("unit"), matches("posting_date", c.ISO_DATE, "YYYY-MM-DD"),
        filled("storage_location"), matches("posted_at", *UTC), one_of("status", ["posted"]),
    ], "[]"),
}


def payload_rules():
    fields = {
        "cycle_started": [("setpoint_temperature_degC", "number"), ("setpoint_vacuum_mbar", "number")],
        "cycle_confirmed": [("sap_confirmation_number", "string"), ("goods_movement_document", "string")],
        "cycle_aborted": [("reason", "string")],
        "cycle_timeout": [("elapsed_minutes", "int"), ("max_cycle_minutes", "int")],
        "sap_confirmation_failed": [("error_code", "string"), ("error_message", "string")],
    }
    rules = []
    for event_type, typed_fields in fields.items():
        this = f"coalesce({text('event_type')} = '{event_type}', false)"
        rules.append(broken(f"{this} and {kind('payload')} = 'NULL'", f"payload: required for {event_type}"))
        rules.append(broken(f"{this} and {kind('payload')} not in ('NULL', 'OBJECT')", "payload: must be object"))
        for field, name in typed_fields:
            inside = f"{this} and {kind('payload')} = 'OBJECT'"
            found = kind(f"payload.{field}")
            rules.append(broken(f"{inside} and {found} = 'NULL'", f"payload.{field}: required"))
            rules.append(broken(f"{inside} and {found} <> 'NULL' and not ({found} {KINDS[name]})",
                                f"payload.{field}: must be {name}"))
    return rules


RULES["C10"] = ("m_events", "o_orderkey", [
    matches("event_id", UUID4, "UUID v4"),
    one_of("event_type", ["cycle_started", "cycle_confirmed", "cycle_aborted", "cycle_timeout", "sap_confirmation_failed"]),
    matches("order_id", ORDER, "ORD-YYYY-NNNNN"), matches("oven_id", OVEN, "oven-NN"), typed("operator_id", "string", True),
    matches("timestamp", *UTC), *payload_rules(),
], "[]")


def gold_rules():
    fields = {
        "order_id": "string", "material_id": "string", "material_description": "string", "plant": "string",
        "oven_id": "string", "cycle_start_time": "string", "cycle_end_time": "string", "actual_duration_minutes": "number",
        "standard_cycle_minutes": "int", "delta_minutes": "number", "peak_temperature_degC": "number",
        "min_vacuum_mbar": "number", "final_moisture_ppm": "number", "target_moisture_ppm": "int", "spec_met": "bool",
        "sap_confirmation_number": "string", "goods_movement_posted": "bool",
    }
    rules = []
    for field, name in fields.items():
        rules.append(broken(f"{kind(field)} = 'NULL'", f"{field}: required"))
        rules.append(broken(f"{kind(field)} <> 'NULL' and not ({kind(field)} {KINDS[name]})", f"{field}: must be {name}"))
    for field, pattern, label in [("order_id", ORDER, "ORD-YYYY-NNNNN"), ("material_id", MATERIAL, "MAT-NNNN"),
                                  ("oven_id", OVEN, "oven-NN"), ("cycle_start_time", *UTC), ("cycle_end_time", *UTC)]:
        wrong = f"{kind(field)} = 'VARCHAR' and not regexp_matches({text(field)}, '{pattern}')"
        rules.append(broken(f"json_type(j, '$.{field}') is null or ({wrong})", f"{field}: must be {label}"))
    rules.append(one_of("plant", PLANTS))
    numeric = " and ".join(f"{kind(f)} {KINDS['number']}" for f in
                           ("actual_duration_minutes", "standard_cycle_minutes", "delta_minutes"))
    rules.append(broken(
        f"""{numeric} and abs(round_even({number('actual_duration_minutes')} - {number('standard_cycle_minutes')}, 0)
          - {number('delta_minutes')}) > 1""", "delta_minutes: does not match duration and standard"))
    rules.append(broken(
        f"""{kind('final_moisture_ppm')} {KINDS['number']} and {kind('target_moisture_ppm')} {KINDS['number']}
          and {kind('spec_met')} = 'BOOLEAN' and ({text('spec_met')} = 'true')
            <> ({number('final_moisture_ppm')} < {number('target_moisture_ppm')})""", "spec_met: does not match moisture"))
    return rules


RULES["C12"] = ("m_gold", "o_orderkey", gold_rules(), "[]")


def validated(contract):
    view, key, _, _ = RULES[contract]

    def run(lake):
        found = c.VALIDATORS[contract](lake.view(view))
        return found.select(key, "is_valid", F.array_join("errors", "; ").alias("problems"))

    return run


def reference(contract):
    view, key, rules, more = RULES[contract]
    return sql(f"""select {key}, len(errors) = 0 as is_valid, array_to_string(errors, '; ') as problems from checked""",
               checked=checked(view, key, rules, more))


def all_checked(lake):
    frames = [
        c.VALIDATORS[name](lake.view(rules[0])).select(F.lit(name).alias("contract"), "is_valid", "errors")
        for name, rules in RULES.items()
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


ALL = {f"checked_{n.lower()}": checked(v, k, r, m) for n, (v, k, r, m) in RULES.items()}
UNION = " union all ".join(f"select '{n}' as contract, errors from checked_{n.lower()}" for n in RULES)

QUERIES = {
    "validate_" + {
        "C1": "reading", "C2": "process_state", "C3": "historian_response", "C4": "order_state", "C5": "confirmation",
        "C6": "order", "C7": "material", "C8": "goods_movement", "C10": "cycle_event", "C12": "gold",
    }[n]: (validated(n), reference(n))
    for n in RULES
}
QUERIES |= {
    "validate_gold_rows": (
        lambda lake: c.validate_gold(c.gold_as_json(lake.gold())).select(
            "order_id", "is_valid", F.array_join("errors", "; ").alias("problems")
        ),
        sql("""select order_id, len(found) = 0 as is_valid, array_to_string(found, '; ') as problems from
  (select order_id, list_filter([case when "peak_temperature_degC" is null then 'peak_temperature_degC: required' end,
    case when min_vacuum_mbar is null then 'min_vacuum_mbar: required' end,
    case when final_moisture_ppm is null then 'final_moisture_ppm: required' end,
    case when spec_met is null then 'spec_met: required' end,
    case when not regexp_matches(order_id, '^ORD-\\d{4}-\\d{5}$') then 'order_id: must be ORD-YYYY-NNNNN' end],
    lambda x: x is not null) as found from gold)"""),
    ),
    "validation_summary": (
        lambda lake: c.validation_summary(all_checked(lake), "contract"),
        sql("""select contract, count(*) filter (where len(errors) = 0) as passed,
  count(*) filter (where len(errors) > 0) as failed, count(*) as total from every group by contract""",
            every=UNION, **ALL),
    ),
    "validation_by_topic": (
        lambda lake: c.validation_summary(c.validate_reading(lake.view("m_readings")), "topic"),
        sql("""select topic, count(*) filter (where len(errors) = 0) as passed, count(*) filter (where len(errors) > 0) as failed,
  count(*) as total from m_readings m join checked_c1 c on m.event_id = c.event_id group by topic""", **ALL),
    ),
    "failing_rules": (
        lambda lake: c.failing_rules(all_checked(lake), "contract"),
        sql(r"""select contract, rule, count(*) as n from (select contract,
  regexp_replace(unnest(errors), '\[\d+\]', '[]', 'g') as rule from every) group by all""", every=UNION, **ALL),
    ),
    "referential_check": (
        lambda lake: c.referential_check(
            {"movements": lake.view("br_movements"), "confirmations": lake.view("br_confirmations"),
             "live readings": lake.view("ad_live"), "events": lake.view("br_events")},
            lake.orders(), lake.materials(),
        ),
        sql("""select * from (select 'movements' as source, order_id as missing_id, count(*) as n_rows from br_movements group by 2
  union all select 'confirmations', order_id, count(*) from br_confirmations group by 2
  union all select 'live readings', order_id, count(*) from ad_live group by 2
  union all select 'events', order_id, count(*) from br_events group by 2)
  where missing_id is not null and missing_id not in (select order_id from s_orders)"""),
    ),
    "range_check": (
        lambda lake: c.range_check(lake.readings()).select("reading_id", "sensor_type", "value", "low", "high"),
        sql("""select reading_id, r.sensor_type, value, low, high from s_readings r join
  (values ('temperature', 20::double, 140::double), ('vacuum', 1::double, 1013::double),
    ('moisture', 200::double, 5000::double)) t(sensor_type, low, high)
  on r.sensor_type = t.sensor_type where value < low or value > high"""),
    ),
}
