import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cyclelake import schemas  # noqa: E402
from cyclelake.session import build_session  # noqa: E402

START = dt.datetime(2026, 6, 3, 6, 0)


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="cyclelake-test-")
    session = build_session("tests", "local[4]", 4, {"spark.checkpoint.dir": folder})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="cyclelake-test-")


def at(minutes=0.0, seconds=0.0):
    return START + dt.timedelta(minutes=minutes, seconds=seconds)


def reading(n, sensor="temperature", value=1.0, minutes=0.0, seconds=0.0, order="ORD-2031-07315", oven="oven-01",
            quality="Good"):
    ts = at(minutes, seconds)
    unit = schemas.UNIT_OF_SENSOR[sensor]
    return (f"r{n:06d}", order, oven, "regensburg", sensor, float(value), unit, quality, ts, ts)


def readings(spark, rows):
    return spark.createDataFrame(rows, schemas.READING)


def event(n, kind, order="ORD-2031-07315", minutes=0.0, oven="oven-01", operator="OP-431", payload="{}"):
    return (f"e{n:06d}", kind, order, oven, operator, at(minutes), payload)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT)


def order(order_id="ORD-2031-07315", material="MAT-0001", status="RELEASED", updated=0.0, **more):
    row = {
        "order_id": order_id, "material_id": material, "plant": "regensburg", "oven_id": "oven-01",
        "planned_start": at(), "planned_end": at(480), "standard_cycle_minutes": 480, "status": status,
        "operator_id": None, "actual_start": None, "actual_end": None, "sap_confirmation_number": None,
        "goods_movement_posted": False, "created_at": at(-1000), "updated_at": at(updated),
    }
    row.update(more)
    return tuple(row[f.name] for f in schemas.ORDER)


def orders(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDER)


# The four seed materials.
MATERIALS = [
    ("MAT-0001", "Power Transformer 100MVA", "H", 300, 480, 600, 130.0, 5.0, 8500.0),
    ("MAT-0002", "Distribution Transformer 1MVA", "F", 500, 240, 300, 120.0, 8.0, 850.0),
    ("MAT-0003", "Instrument Transformer CT 36kV", "B", 800, 120, 150, 105.0, 12.0, 120.0),
    ("MAT-0004", "Power Transformer 400MVA", "H", 200, 720, 900, 135.0, 3.0, 24000.0),
]


def materials(spark):
    return spark.createDataFrame([(*m, at(-10000)) for m in MATERIALS], schemas.MATERIAL)
