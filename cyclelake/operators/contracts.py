"""Contract checks over raw JSON text.

Each ``validate_*`` adds ``errors`` (array of rule texts, empty when fine) and ``is_valid``. The text is parsed
once to a variant, because a typed parse would hide whether a value was a string, an integer or a boolean.
A boolean never counts as a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelake.schemas import (
    EVENT_PAYLOAD, EVENT_TYPES, INSULATION_CLASSES, ORDER_STATUSES, OVEN_STATUSES, PLANTS, QUALITIES, SENSOR_TYPES,
    SHOP_FLOOR_STATUSES, UNIT_OF_SENSOR, UNITS, range_table,
)

# Formats of the identifiers and timestamps.
UUID4 = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
OVEN = r"^oven-\d{2}$"
ORDER_ID = r"^ORD-\d{4}-\d{5}$"
MATERIAL_ID = r"^MAT-\d{4}$"
CONFIRMATION_NUMBER = r"^CONF-\d{4}-\d{5}$"
MOVEMENT_NUMBER = r"^GR-\d{4}-\d{6}$"
ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


class Json:
    """Typed access to the fields of a JSON object. ``fields`` collects what the rules ask for; ``read`` then takes
    all fields of an object apart in one go, which is several times faster than one path lookup per use."""

    def __init__(self, tag: str = "", row: Column | None = None):
        self.tag, self.row, self.fields, self.children = tag, row, {}, {}

    def child(self, field: str) -> Json:
        """The object below ``field``."""
        self.fields.setdefault(field, set())
        return self.children.setdefault(field, Json(f"{self.tag}_{field}"))

    def _use(self, field: str, what: str) -> Column:
        self.fields.setdefault(field, set()).add(what)
        name = f"_{what}{self.tag}_{field}"
        return F.col(name) if self.row is None else self.row.getField(name)

    def text(self, field: str) -> Column:
        return self._use(field, "text")

    def _type(self, field: str) -> Column:
        return self._use(field, "type")

    def variant(self, field: str) -> Column:
        return self._use(field, "variant")

    def taken_apart(self, variant: Column) -> Column:
        """The asked-for fields of the object in ``variant`` as a struct of variants; null when it is no object."""
        shape = ", ".join(f"`{f}`: variant" for f in self.fields)
        return F.try_variant_get(variant, "$", f"struct<{shape}>")

    def read(self, parts: Column) -> list[Column]:
        """The types and texts the rules use, out of the struct made by ``taken_apart``."""
        columns = []
        for field, uses in self.fields.items():
            value = parts.getField(field)
            found = {
                "type": F.schema_of_variant(value), "text": F.try_variant_get(value, "$", "string"), "variant": value,
                "absent": value.isNull(), "void": F.is_variant_null(value),
                # Whether it is one, without the schema of everything inside.
                "array": F.try_variant_get(value, "$", "array<variant>").isNotNull(),
                "object": F.try_variant_get(value, "$", "map<string, variant>").isNotNull(),
            }
            columns += [found[u].alias(f"_{u}{self.tag}_{field}") for u in sorted(uses)]
        return columns

    def number(self, field: str) -> Column:
        return self.text(field).try_cast("double")

    def missing(self, field: str) -> Column:
        return self._use(field, "absent")

    def null(self, field: str) -> Column:
        """Absent or JSON null."""
        return self._use(field, "absent") | F.coalesce(self._use(field, "void"), F.lit(True))

    def is_a(self, field: str, kind: str) -> Column:
        if kind in ("array", "object"):
            return F.coalesce(self._use(field, kind), F.lit(False))
        found = F.coalesce(self._type(field), F.lit("VOID"))
        return {
            "string": found == "STRING", "bool": found == "BOOLEAN", "int": found == "BIGINT",
            "number": (found == "BIGINT") | (found == "DOUBLE") | (found == "FLOAT") | found.startswith("DECIMAL"),
        }[kind]

    # Each rule gives the text of the broken rule, or null.
    def matches(self, field: str, pattern: str, label: str, nullable: bool = False) -> Column:
        good = self.is_a(field, "string") & self.text(field).rlike(pattern)
        if nullable:
            good = self.null(field) | good
        return rule(~F.coalesce(good, F.lit(False)), f"{field}: must be {label}" + (" or null" if nullable else ""))

    def one_of(self, field: str, values) -> Column:
        good = self.is_a(field, "string") & self.text(field).isin(*values)
        return rule(~F.coalesce(good, F.lit(False)), f"{field}: must be one of {', '.join(values)}")

    def typed(self, field: str, kind: str, nullable: bool = False) -> Column:
        good = self.is_a(field, kind)
        if nullable:
            good = self.null(field) | good
        return rule(~good, f"{field}: must be {kind}" + (" or null" if nullable else ""))

    def positive(self, field: str, kind: str) -> Column:
        good = self.is_a(field, kind) & (self.number(field) > 0)
        return rule(~F.coalesce(good, F.lit(False)), f"{field}: must be positive {kind}")

    def filled(self, field: str) -> Column:
        good = self.is_a(field, "string") & (F.length(self.text(field)) > 0)
        return rule(~F.coalesce(good, F.lit(False)), f"{field}: must be non-empty string")

    def required(self, fields) -> list[Column]:
        return [rule(self.missing(f), f"{f}: required") for f in fields]


def rule(broken: Column, text: str) -> Column:
    return F.when(broken, F.lit(text))


def check(df: DataFrame, raw: str, rules, extra=None) -> DataFrame:
    """Adds errors and is_valid. ``rules`` maps a Json to a list of rule columns; ``extra`` maps it to an
    array of further texts. The fields come out of a one-row ``inline``: a later filter on is_valid is not pushed
    below it, where it would parse the text again for every rule."""
    json = Json()
    found = F.array_compact(F.array(*rules(json)))
    if extra is not None:
        found = F.concat(found, extra(json))
    parsed = df.withColumn("_v", F.try_parse_json(raw)).withColumn("_s", json.taken_apart(F.col("_v")))
    # Only an object can be taken apart; the schema of the whole text would cost more than parsing it.
    fields = [F.col("_v").isNull().alias("_unread"), F.col("_s").isNotNull().alias("_whole"), *json.read(F.col("_s"))]
    for field, child in json.children.items():
        parsed = parsed.withColumn(f"_s_{field}", child.taken_apart(F.col("_s").getField(field)))
        fields += child.read(F.col(f"_s_{field}"))
    read = parsed.select("*", F.inline(F.array(F.struct(*fields))))
    errors = (
        F.when(F.col("_unread"), F.array(F.lit("payload: not valid JSON")))
        .when(~F.col("_whole"), F.array(F.lit("payload: must be object")))
        .otherwise(found)
    )
    return read.select(*df.columns, errors.alias("errors")).withColumn("is_valid", F.size("errors") == 0)


def validate_reading(df: DataFrame, raw: str = "raw_payload", strict_fields: bool = True) -> DataFrame:
    """Sensor message. With ``strict_fields`` a field outside the contract makes the row invalid."""
    # The fields of the contract.
    known = [
        "reading_id", "order_id", "oven_id", "plant", "sensor_type", "value", "unit", "quality", "timestamp_opc",
        "timestamp_mqtt",
    ]

    def rules(j: Json):
        unit, sensor = j.text("unit"), j.text("sensor_type")
        expected = F.create_map(*[F.lit(x) for pair in UNIT_OF_SENSOR.items() for x in pair])
        mismatch = unit.isin(*UNITS) & sensor.isin(*SENSOR_TYPES) & (unit != expected[sensor])
        return [
            j.matches("reading_id", UUID4, "UUID v4"),
            j.typed("order_id", "string", nullable=True),
            j.matches("oven_id", OVEN, "oven-NN"),
            j.one_of("plant", PLANTS), j.one_of("sensor_type", SENSOR_TYPES),
            j.typed("value", "number"),
            j.one_of("unit", UNITS), rule(mismatch, "unit: does not fit sensor_type"),
            j.one_of("quality", QUALITIES),
            j.matches("timestamp_opc", ISO_UTC, "ISO 8601 UTC"), j.matches("timestamp_mqtt", ISO_UTC, "ISO 8601 UTC"),
        ]

    def unexpected(_):
        keys = F.array_except(F.json_object_keys(raw), F.array(*[F.lit(k) for k in known]))
        text = F.array(F.concat(F.lit("unexpected fields: "), F.array_join(F.array_sort(keys), ", ")))
        return F.when(F.size(keys) > 0, text).otherwise(F.array().cast("array<string>"))

    return check(df, raw, rules, unexpected if strict_fields else None)


def validate_process_state(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    # Numeric fields of the contract.
    numbers = ["temperature_degC", "vacuum_mbar", "moisture_ppm", "cycle_elapsed_minutes"]
    return check(df, raw, lambda j: [
        j.matches("oven_id", OVEN, "oven-NN"),
        j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN", nullable=True),
        j.one_of("status", OVEN_STATUSES),
        *[j.typed(f, "number", nullable=True) for f in numbers],
        rule(j.is_a("cycle_elapsed_minutes", "number") & (j.number("cycle_elapsed_minutes") < 0),
             "cycle_elapsed_minutes: must be >= 0"),
        j.typed("moisture_threshold_met", "bool", nullable=True),
        j.matches("timestamp", ISO_UTC, "ISO 8601 UTC"),
    ])


def validate_historian_response(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Checks the envelope and every element; element rules carry the index."""

    def element_rules(j: Json) -> Column:
        return F.array_compact(F.array(
            j.matches("reading_id", UUID4, "UUID v4"), j.matches("timestamp_opc", ISO_UTC, "ISO 8601 UTC"),
            j.one_of("sensor_type", SENSOR_TYPES), j.typed("value", "number"), j.one_of("unit", UNITS),
            j.one_of("quality", QUALITIES),
        ))

    asked = Json()
    element_rules(asked)

    def opened(e: Column) -> Column:
        return F.struct(asked.taken_apart(e).alias("_s"))

    def parts(e: Column) -> Column:
        return F.struct(e.getField("_s").isNotNull().alias("_whole"), *asked.read(e.getField("_s")))

    def broken(e: Column, i: Column) -> Column:
        prefix = F.concat(F.lit("readings["), i.cast("string"), F.lit("]"))
        named = F.transform(element_rules(Json(row=e)), lambda t: F.concat(prefix, F.lit("."), t))
        return F.when(e.getField("_whole"), named).otherwise(F.array(F.concat(prefix, F.lit(": must be object"))))

    def items(j: Json) -> Column:
        return F.try_variant_get(j.variant("readings"), "$", "array<variant>")

    def rules(j: Json):
        count = j.number("count")
        return [
            j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"),
            rule(~j.is_a("count", "int") | (count < 0), "count: must be non-negative int"),
            j.typed("readings", "array"),
            rule(j.is_a("count", "int") & (count != F.size(items(j))), "count: does not match readings"),
        ]

    def elements(j: Json):
        found = F.flatten(F.transform(F.transform(F.transform(items(j), opened), parts), broken))
        return F.coalesce(found, F.array().cast("array<string>"))

    return check(df, raw, rules, elements)


def validate_order_state(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    return check(df, raw, lambda j: [
        j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"), j.one_of("status", SHOP_FLOOR_STATUSES),
        j.typed("operator_id", "string", nullable=True),
        j.matches("cycle_confirmed_at", ISO_UTC, "ISO 8601 UTC", nullable=True),
        j.typed("quality_check_passed", "bool", nullable=True),
    ])


def validate_confirmation(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    return check(df, raw, lambda j: [
        *j.required(["order_id", "sap_confirmation_number", "status", "posted_at"]),
        j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"),
        j.matches("sap_confirmation_number", CONFIRMATION_NUMBER, "CONF-YYYY-NNNNN"),
        j.one_of("status", ["CONFIRMED"]), j.matches("posted_at", ISO_UTC, "ISO 8601 UTC"),
    ])


def validate_order(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    # Required fields of the contract.
    stamps, open_stamps = ["planned_start", "planned_end", "created_at", "updated_at"], ["actual_start", "actual_end"]
    texts = ["operator_id", "sap_confirmation_number"]
    keys = [
        "order_id", "material_id", "plant", "oven_id", "planned_start", "planned_end", "standard_cycle_minutes",
        "status", "operator_id", "actual_start", "actual_end", "sap_confirmation_number", "goods_movement_posted",
        "created_at", "updated_at",
    ]
    return check(df, raw, lambda j: [
        *j.required(keys),
        j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"), j.matches("material_id", MATERIAL_ID, "MAT-NNNN"),
        j.one_of("plant", PLANTS), j.matches("oven_id", OVEN, "oven-NN"),
        *[j.matches(f, ISO_UTC, "ISO 8601 UTC") for f in stamps],
        *[j.matches(f, ISO_UTC, "ISO 8601 UTC", nullable=True) for f in open_stamps],
        j.one_of("status", ORDER_STATUSES), j.positive("standard_cycle_minutes", "int"),
        j.typed("goods_movement_posted", "bool"),
        *[j.typed(f, "string", nullable=True) for f in texts],
    ])


def validate_material(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    # Numeric fields of the contract.
    ints = ["target_moisture_ppm", "standard_cycle_minutes", "max_cycle_minutes"]
    numbers = ["target_temperature_degC", "target_vacuum_mbar", "weight_kg"]

    def rules(j: Json):
        # An absent duration counts as 0, a null or mistyped one is left to its own rule.
        minutes = lambda f: F.when(j.missing(f), F.lit(0.0)).when(j.is_a(f, "int"), j.number(f))
        return [
            *j.required(["material_id", "material_description", "insulation_class", *ints, *numbers, "updated_at"]),
            j.matches("material_id", MATERIAL_ID, "MAT-NNNN"), j.filled("material_description"),
            j.one_of("insulation_class", INSULATION_CLASSES),
            *[j.positive(f, "int") for f in ints],
            rule(minutes("max_cycle_minutes") <= minutes("standard_cycle_minutes"),
                 "max_cycle_minutes: must be > standard_cycle_minutes"),
            *[j.positive(f, "number") for f in numbers],
            j.matches("updated_at", ISO_UTC, "ISO 8601 UTC"),
        ]

    return check(df, raw, rules)


def validate_goods_movement(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    # Required fields of the contract.
    keys = [
        "document_number", "order_id", "material_id", "movement_type", "quantity", "unit", "posting_date",
        "storage_location", "posted_at", "status",
    ]
    return check(df, raw, lambda j: [
        *j.required(keys),
        j.matches("document_number", MOVEMENT_NUMBER, "GR-YYYY-NNNNNN"),
        j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"), j.matches("material_id", MATERIAL_ID, "MAT-NNNN"),
        j.one_of("movement_type", ["GR_PRODUCTION"]), j.positive("quantity", "number"), j.filled("unit"),
        j.matches("posting_date", ISO_DATE, "YYYY-MM-DD"), j.filled("storage_location"),
        j.matches("posted_at", ISO_UTC, "ISO 8601 UTC"), j.one_of("status", ["posted"]),
    ])


def validate_cycle_event(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    def rules(j: Json):
        inner, found = j.child("payload"), []
        for event_type, fields in EVENT_PAYLOAD.items():
            this = F.coalesce(j.text("event_type") == event_type, F.lit(False))
            found.append(rule(this & j.null("payload"), f"payload: required for {event_type}"))
            found.append(rule(this & ~j.null("payload") & ~j.is_a("payload", "object"), "payload: must be object"))
            inside = this & j.is_a("payload", "object")
            for field, kind in fields.items():
                found.append(rule(inside & inner.null(field), f"payload.{field}: required"))
                wrong = ~inner.null(field) & ~inner.is_a(field, kind)
                found.append(rule(inside & wrong, f"payload.{field}: must be {kind}"))
        return [
            j.matches("event_id", UUID4, "UUID v4"), j.one_of("event_type", EVENT_TYPES),
            j.matches("order_id", ORDER_ID, "ORD-YYYY-NNNNN"), j.matches("oven_id", OVEN, "oven-NN"),
            j.typed("operator_id", "string", nullable=True), j.matches("timestamp", ISO_UTC, "ISO 8601 UTC"), *found,
        ]

    return check(df, raw, rules)


# Mandatory Gold columns with their JSON type.
GOLD_FIELDS = {
    "order_id": "string", "material_id": "string", "material_description": "string", "plant": "string",
    "oven_id": "string", "cycle_start_time": "string", "cycle_end_time": "string",
    "actual_duration_minutes": "number", "standard_cycle_minutes": "int", "delta_minutes": "number",
    "peak_temperature_degC": "number", "min_vacuum_mbar": "number", "final_moisture_ppm": "number",
    "target_moisture_ppm": "int", "spec_met": "bool", "sap_confirmation_number": "string",
    "goods_movement_posted": "bool",
}


def validate_gold(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Gold row as JSON: mandatory typed fields, formats, and agreement of delta and spec flag."""

    def rules(j: Json):
        broken = []
        for field, kind in GOLD_FIELDS.items():
            broken.append(rule(j.null(field), f"{field}: required"))
            broken.append(rule(~j.null(field) & ~j.is_a(field, kind), f"{field}: must be {kind}"))
        formats = {
            "order_id": (ORDER_ID, "ORD-YYYY-NNNNN"), "material_id": (MATERIAL_ID, "MAT-NNNN"),
            "oven_id": (OVEN, "oven-NN"), "cycle_start_time": (ISO_UTC, "ISO 8601 UTC"),
            "cycle_end_time": (ISO_UTC, "ISO 8601 UTC"),
        }
        for field, (pattern, label) in formats.items():
            wrong = j.missing(field) | (j.is_a(field, "string") & ~j.text(field).rlike(pattern))
            broken.append(rule(wrong, f"{field}: must be {label}"))
        broken.append(j.one_of("plant", PLANTS))
        measured = ["actual_duration_minutes", "standard_cycle_minutes", "delta_minutes"]
        numeric = j.is_a(measured[0], "number") & j.is_a(measured[1], "number") & j.is_a(measured[2], "number")
        expected = F.bround(j.number(measured[0]) - j.number(measured[1]), 0)
        off = F.abs(expected - j.number("delta_minutes")) > 1
        broken.append(rule(numeric & off, "delta_minutes: does not match duration and standard"))
        judged = j.is_a("final_moisture_ppm", "number") & j.is_a("target_moisture_ppm", "number") & j.is_a("spec_met", "bool")
        met = j.number("final_moisture_ppm") < j.number("target_moisture_ppm")
        broken.append(rule(judged & (j.text("spec_met") != met.cast("string")), "spec_met: does not match moisture"))
        return broken

    return check(df, raw, rules)


def gold_as_json(gold: DataFrame) -> DataFrame:
    """Gold rows as contract JSON, for validate_gold."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "ignoreNullFields": "false"}
    return gold.select("order_id", F.to_json(F.struct(*gold.columns), options).alias("raw_payload"))


VALIDATORS = {
    "C1": validate_reading, "C2": validate_process_state, "C3": validate_historian_response,
    "C4": validate_order_state, "C5": validate_confirmation, "C6": validate_order, "C7": validate_material,
    "C8": validate_goods_movement, "C10": validate_cycle_event, "C12": validate_gold,
}


def validation_summary(validated: DataFrame, *by: str) -> DataFrame:
    """Passed and failed rows, overall or per group."""
    return validated.groupBy(*by).agg(
        F.count_if("is_valid").alias("passed"), F.count_if(~F.col("is_valid")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def failing_rules(validated: DataFrame, *by: str) -> DataFrame:
    """Broken rules with the number of rows, element indexes removed."""
    # The outer form: a plain explode adds a filter on the array, which would evaluate all rules twice more.
    broken = validated.select(*by, F.explode_outer("errors").alias("rule")).filter(F.col("rule").isNotNull())
    broken = broken.withColumn("rule", F.regexp_replace("rule", r"\[\d+\]", "[]"))
    return broken.groupBy(*by, "rule").agg(F.count(F.lit(1)).alias("n"))


def referential_check(children: dict[str, DataFrame], orders: DataFrame, materials: DataFrame) -> DataFrame:
    """Order ids in readings, events or movements without an order, and order materials without a master, with
    the number of rows. Ids are counted first, so only distinct ids meet the parent tables."""

    def orphans(name, child, key, parent):
        counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        lost = counted.join(parent.select(key).distinct(), key, "left_anti")
        return lost.select(F.lit(name).alias("source"), F.col(key).alias("missing_id"), "n_rows")

    report = orphans("orders", orders, "material_id", materials)
    for name, child in children.items():
        report = report.unionByName(orphans(name, child, "order_id", orders))
    return report


def range_check(readings: DataFrame) -> DataFrame:
    """Readings outside the typical range of their sensor."""
    limits = F.broadcast(range_table(readings.sparkSession).select("sensor_type", "low", "high"))
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return readings.join(limits, "sensor_type").filter(~inside)
