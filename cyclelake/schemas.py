"""Declared schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values of the domain.
PLANTS = ["regensburg", "kirchheim"]
SENSOR_TYPES = ["temperature", "vacuum", "moisture"]
UNITS = ["degC", "mbar", "ppm"]
QUALITIES = ["Good", "Bad", "Uncertain"]
EVENT_TYPES = ["cycle_started", "cycle_confirmed", "cycle_aborted", "cycle_timeout", "sap_confirmation_failed"]
ORDER_STATUSES = ["CREATED", "RELEASED", "IN_PROGRESS", "CONFIRMED", "ABORTED", "CLOSED"]
SHOP_FLOOR_STATUSES = ["released", "in-progress", "confirmed", "closed"]
OVEN_STATUSES = ["idle", "running", "cycle_complete", "timeout"]
INSULATION_CLASSES = ["A", "B", "F", "H"]
UNIT_OF_SENSOR = {"temperature": "degC", "vacuum": "mbar", "moisture": "ppm"}
TYPICAL_RANGE = {"temperature": (20.0, 140.0), "vacuum": (1.0, 1013.0), "moisture": (200.0, 5000.0)}
SENSOR_NOISE = {"temperature": 0.5, "vacuum": 0.05, "moisture": 10.0}
AMBIENT_TEMPERATURE = 25.0
ATMOSPHERIC_PRESSURE = 1013.0
INITIAL_MOISTURE = 5000.0
VACUUM_TAU_MINUTES = 10.0
VACUUM_FLOOR = 0.1
WARMING_MINUTES = 60.0
COMPRESSION_FACTOR = 60.0

# Allowed status changes of the three order machines.
ERP_TRANSITIONS = [
    ("CREATED", "RELEASED"), ("CREATED", "ABORTED"), ("RELEASED", "IN_PROGRESS"), ("RELEASED", "ABORTED"),
    ("IN_PROGRESS", "CONFIRMED"), ("IN_PROGRESS", "ABORTED"), ("CONFIRMED", "CLOSED"),
]
SHOP_FLOOR_TRANSITIONS = [("released", "in-progress"), ("in-progress", "confirmed"), ("confirmed", "closed")]
LIFECYCLE_TRANSITIONS = [
    ("RELEASED", "RUNNING"), ("RUNNING", "THRESHOLD_MET"), ("RUNNING", "TIMEOUT"), ("RUNNING", "ABORTED"),
    ("TIMEOUT", "RUNNING"), ("TIMEOUT", "ABORTED"), ("THRESHOLD_MET", "CONFIRMED"),
    ("THRESHOLD_MET", "CONFIRM_FAILED"), ("CONFIRM_FAILED", "THRESHOLD_MET"),
]
MACHINES = {"erp": ERP_TRANSITIONS, "shop_floor": SHOP_FLOOR_TRANSITIONS, "lifecycle": LIFECYCLE_TRANSITIONS}

# Payload fields of each event type with their JSON type.
EVENT_PAYLOAD = {
    "cycle_started": {"setpoint_temperature_degC": "number", "setpoint_vacuum_mbar": "number"},
    "cycle_confirmed": {"sap_confirmation_number": "string", "goods_movement_document": "string"},
    "cycle_aborted": {"reason": "string"},
    "cycle_timeout": {"elapsed_minutes": "int", "max_cycle_minutes": "int"},
    "sap_confirmation_failed": {"error_code": "string", "error_message": "string"},
}
PAYLOAD_SPARK_TYPE = {"number": "double", "string": "string", "int": "int"}



# Column names and types of the tables.
READING = T.StructType([
    T.StructField("reading_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("oven_id", T.StringType()),
    T.StructField("plant", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("quality", T.StringType()),
    T.StructField("timestamp_opc", T.TimestampType()),
    T.StructField("timestamp_mqtt", T.TimestampType()),
])
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("oven_id", T.StringType()),
    T.StructField("operator_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])
ORDER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("material_id", T.StringType()),
    T.StructField("plant", T.StringType()),
    T.StructField("oven_id", T.StringType()),
    T.StructField("planned_start", T.TimestampType()),
    T.StructField("planned_end", T.TimestampType()),
    T.StructField("standard_cycle_minutes", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("operator_id", T.StringType()),
    T.StructField("actual_start", T.TimestampType()),
    T.StructField("actual_end", T.TimestampType()),
    T.StructField("sap_confirmation_number", T.StringType()),
    T.StructField("goods_movement_posted", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
MATERIAL = T.StructType([
    T.StructField("material_id", T.StringType()),
    T.StructField("material_description", T.StringType()),
    T.StructField("insulation_class", T.StringType()),
    T.StructField("target_moisture_ppm", T.IntegerType()),
    T.StructField("standard_cycle_minutes", T.IntegerType()),
    T.StructField("max_cycle_minutes", T.IntegerType()),
    T.StructField("target_temperature_degC", T.DoubleType()),
    T.StructField("target_vacuum_mbar", T.DoubleType()),
    T.StructField("weight_kg", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])
MOVEMENT = T.StructType([
    T.StructField("document_number", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("material_id", T.StringType()),
    T.StructField("movement_type", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("posting_date", T.DateType()),
    T.StructField("storage_location", T.StringType()),
    T.StructField("posted_at", T.TimestampType()),
])
CONFIRMATION = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("operation_id", T.StringType()),
    T.StructField("confirmed_quantity", T.DoubleType()),
    T.StructField("actual_start", T.TimestampType()),
    T.StructField("actual_end", T.TimestampType()),
    T.StructField("operator_id", T.StringType()),
    T.StructField("final_moisture_ppm", T.DoubleType()),
    T.StructField("spec_met", T.BooleanType()),
])
GOLD = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("material_id", T.StringType()),
    T.StructField("material_description", T.StringType()),
    T.StructField("plant", T.StringType()),
    T.StructField("oven_id", T.StringType()),
    T.StructField("cycle_start_time", T.TimestampType()),
    T.StructField("cycle_end_time", T.TimestampType()),
    T.StructField("actual_duration_minutes", T.DoubleType()),
    T.StructField("standard_cycle_minutes", T.IntegerType()),
    T.StructField("delta_minutes", T.DoubleType()),
    T.StructField("peak_temperature_degC", T.DoubleType()),
    T.StructField("min_vacuum_mbar", T.DoubleType()),
    T.StructField("final_moisture_ppm", T.DoubleType()),
    T.StructField("avg_moisture_ppm", T.DoubleType()),
    T.StructField("target_moisture_ppm", T.IntegerType()),
    T.StructField("spec_met", T.BooleanType()),
    T.StructField("temperature_limit_met", T.BooleanType()),
    T.StructField("quality_check_passed", T.BooleanType()),
    T.StructField("operator_id", T.StringType()),
    T.StructField("sap_confirmation_number", T.StringType()),
    T.StructField("goods_movement_posted", T.BooleanType()),
])


def transition_table(spark: SparkSession, machine: str = "erp") -> DataFrame:
    """Allowed (from_status, to_status) pairs; a handful of fixed rows, safe to broadcast."""
    return spark.createDataFrame(MACHINES[machine], "from_status string, to_status string")


def range_table(spark: SparkSession) -> DataFrame:
    rows = [(s, low, high, UNIT_OF_SENSOR[s]) for s, (low, high) in TYPICAL_RANGE.items()]
    return spark.createDataFrame(rows, "sensor_type string, low double, high double, unit string")
