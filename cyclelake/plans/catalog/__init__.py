"""The query catalogue: name -> (function of the lake, reference SQL or None)."""

from __future__ import annotations

from importlib import import_module

from cyclelake.plans.adapters import plain
from cyclelake.plans.tables import Lake

AREAS = ["bronze", "silver_gold", "dashboard", "state", "order", "contract", "series", "stream"]


def entries() -> dict:
    found: dict = {}
    for area in AREAS:
        for name, entry in import_module(f"cyclelake.plans.catalog.{area}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found


def runner(fn):
    def run(spark, sf_dir):
        # Instants are read and shown in UTC whatever the session was started with.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(fn(Lake(spark, sf_dir)))

    return run
