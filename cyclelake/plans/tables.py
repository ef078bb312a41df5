"""Silver and Gold over the adapter views, the inputs most catalogue queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclelake.functions.joins import hot_keys
from cyclelake.operators import gold as g
from cyclelake.operators import silver as s
from cyclelake.plans.adapters import view


class Lake:
    """Lazy access to every table of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def view(self, name: str, live=()) -> DataFrame:
        return view(self.spark, self.sf_dir, name, live)

    def readings(self) -> DataFrame:
        return s.silver_readings(self.view("br_readings"))

    def hot_orders(self) -> DataFrame | None:
        """Heavy order ids, counted in Bronze, which spares operators over Silver a second run of the dedupe."""
        return hot_keys(self.view("br_readings"), "order_id")

    def events(self) -> DataFrame:
        return s.silver_cycle_events(self.view("br_events"))

    def pairs(self) -> DataFrame:
        return s.cycle_pairs(self.events())

    def orders(self) -> DataFrame:
        return s.silver_orders(self.view("br_orders"))

    def materials(self) -> DataFrame:
        return s.silver_materials(self.view("br_materials"))

    def order_state(self) -> DataFrame:
        return self.view("order_state")

    def gold(self) -> DataFrame:
        return g.gold_from_bronze(
            self.view("br_events"), self.view("br_orders"), self.view("br_materials"), self.view("br_readings"),
            self.order_state(),
        )
