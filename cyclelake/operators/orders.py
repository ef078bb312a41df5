"""Orders, confirmations, goods movements and the checks over their histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelake.functions.joins import join_dimension, join_per_key
from cyclelake.functions.ordered import OrderedSeries, as_of_value
from cyclelake.functions.timing import as_of_column, minutes_between
from cyclelake.schemas import ORDER_STATUSES, transition_table

# Status that each event type leaves behind.
STATUS_AFTER_EVENT = {
    "cycle_started": "in-progress", "cycle_confirmed": "closed", "cycle_aborted": "ABORTED",
    "cycle_timeout": "TIMEOUT", "sap_confirmation_failed": "CONFIRM_FAILED",
}


def list_orders(orders: DataFrame, status: str | None = None, plant: str | None = None) -> DataFrame:
    """Orders by status (any letter case) and plant."""
    if status:
        if status.upper() not in ORDER_STATUSES:
            raise ValueError(f"unknown order status {status!r}")
        orders = orders.filter(F.col("status") == status.upper())
    return orders.filter(F.col("plant") == plant) if plant else orders


def lookup(keys: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows found for a batch of keys, and the keys not found."""
    asked = keys.select(key).distinct()
    return table.join(asked, key, "left_semi"), asked.join(table.select(key), key, "left_anti")


def orders_with_spec(orders: DataFrame, materials: DataFrame) -> DataFrame:
    """Operator list: order with material description, target moisture and standard duration."""
    spec = materials.select("material_id", "material_description", "target_moisture_ppm", "standard_cycle_minutes")
    return join_dimension(orders.drop("standard_cycle_minutes"), spec, "material_id", "left", "order_id")


def audit_transitions(history: DataFrame, machine: str = "erp", slice_days: int = 30) -> DataFrame:
    """Consecutive status pairs of an order that its machine does not allow. Repeated pulls of one version
    count once."""
    steps = history.select("order_id", "status", "updated_at").distinct()
    series = OrderedSeries(steps, ["order_id"], ["updated_at", "status"], slice_days * 1440)
    changes = series.with_previous(from_status="status").filter(F.col("from_status").isNotNull())
    changes = changes.withColumnRenamed("status", "to_status")
    allowed = F.broadcast(transition_table(history.sparkSession, machine))
    return changes.join(allowed, ["from_status", "to_status"], "left_anti").select(
        "order_id", "from_status", "to_status", "updated_at"
    )


def order_state_from_events(events: DataFrame) -> DataFrame:
    """Current state per order: the last event wins."""
    last = F.max_by(F.struct("event_type", "event_time"), F.struct("event_time", "event_id")).alias("_e")
    status = F.create_map(*[F.lit(x) for pair in STATUS_AFTER_EVENT.items() for x in pair])
    return events.filter(F.col("event_type").isin(*STATUS_AFTER_EVENT)).groupBy("order_id").agg(last).select(
        "order_id", status[F.col("_e.event_type")].alias("status"), F.col("_e.event_time").alias("since")
    )


def confirmation_audit(confirmations: DataFrame, history: DataFrame, slice_days: int = 30) -> DataFrame:
    """Each confirmation classified against the order status just before it: ok (IN_PROGRESS or RELEASED),
    already_confirmed, invalid_status or not_found. Of several acceptable ones only the first is ok."""
    width = slice_days * 1440
    # Known orders are marked on the input, before the as-of scan, so that the scan is not repeated for it.
    ids = history.select("order_id").distinct().withColumn("_known", F.lit(True))
    asked = join_per_key(confirmations, ids, "order_id", "left", "posted_at")
    versions = history.select("order_id", "status", "updated_at")
    seen = as_of_value(
        asked, versions, ["order_id"], ("posted_at", "operation_id"), ("updated_at", "status"),
        F.col("status"), "status_before", inclusive=False, width=width,
    )
    acceptable = F.col("status_before").isin("IN_PROGRESS", "RELEASED")
    # One series per order and acceptability, so that positions count acceptable confirmations only.
    seen = seen.withColumn("_ok", F.coalesce(acceptable, F.lit(False)))
    order = ["posted_at", "operation_id", "operator_id", "actual_end"]
    ranked = OrderedSeries(seen, ["order_id", "_ok"], order, width).with_row_number("_n")
    outcome = (
        F.when(F.col("_known").isNull(), "not_found")
        .when(F.col("_ok") & (F.col("_n") == 1), "ok")
        .when(F.col("_ok") | (F.col("status_before") == "CONFIRMED"), "already_confirmed")
        .otherwise("invalid_status")
    )
    return ranked.withColumn("outcome", outcome).drop("_known", "_ok", "_n")


def apply_confirmations(orders: DataFrame, audited: DataFrame) -> DataFrame:
    """Orders after the accepted confirmations."""
    accepted = audited.filter(F.col("outcome") == "ok").select(
        "order_id", F.struct("operator_id", "actual_start", "actual_end", "sap_confirmation_number",
                             "posted_at").alias("_c"),
    )
    joined = orders.join(accepted, "order_id", "left")
    change = F.col("_c").isNotNull()
    return joined.withColumns({
        "status": F.when(change, "CONFIRMED").otherwise(F.col("status")),
        "operator_id": F.when(change, F.col("_c.operator_id")).otherwise(F.col("operator_id")),
        "actual_start": F.when(change, F.col("_c.actual_start")).otherwise(F.col("actual_start")),
        "actual_end": F.when(change, F.col("_c.actual_end")).otherwise(F.col("actual_end")),
        "sap_confirmation_number": F.coalesce("_c.sap_confirmation_number", "sap_confirmation_number"),
        "updated_at": F.coalesce("_c.posted_at", "updated_at"),
    }).drop("_c")


def flag_goods_movement(orders: DataFrame, movements: DataFrame) -> DataFrame:
    """goods_movement_posted is true when a movement exists for the order."""
    posted = movements.select("order_id").distinct().withColumn("_posted", F.lit(True))
    joined = orders.drop("goods_movement_posted").join(posted, "order_id", "left")
    return joined.withColumn("goods_movement_posted", F.coalesce("_posted", F.lit(False))).drop("_posted")


def movements_of(movements: DataFrame, order_ids: DataFrame) -> DataFrame:
    return movements.join(order_ids.select("order_id").distinct(), "order_id", "left_semi")


def merge_keep_local(local: DataFrame, erp: DataFrame) -> DataFrame:
    """Local orders unchanged, plus ERP orders not held locally with status released."""
    columns = ["order_id", "material_id", "plant", "oven_id", "status"]
    new = erp.join(local.select("order_id"), "order_id", "left_anti").withColumn("status", F.lit("released"))
    return local.select(*columns).unionByName(new.select(*columns))


def spec_met_at_confirmation(quality="quality_check_passed", final="final_moisture_ppm",
                             target="target_moisture_ppm") -> Column:
    """The shop-floor rule: quality check passed and, if there is a target, final moisture below it."""
    return F.col(quality) & (F.col(target).isNull() | (F.col(final) < F.col(target)))


def timeouts(orders: DataFrame, materials: DataFrame, as_of=None, extensions: DataFrame | None = None,
             running=("IN_PROGRESS",)) -> DataFrame:
    """Running orders past the maximum duration of their material plus granted extensions."""
    limits = materials.select("material_id", "max_cycle_minutes")
    open_orders = orders.filter(F.col("status").isin(*running) & F.col("actual_start").isNotNull())
    joined = join_dimension(open_orders, limits, "material_id", spread_by="order_id")
    allowed = F.col("max_cycle_minutes")
    if extensions is not None:
        granted = extensions.groupBy("order_id").agg(F.sum("extension_minutes").alias("_granted"))
        joined = joined.join(granted, "order_id", "left")
        allowed = allowed + F.coalesce("_granted", F.lit(0))
    elapsed = minutes_between("actual_start", as_of_column(as_of))
    report = joined.select(
        "order_id", "oven_id", "material_id", elapsed.alias("elapsed_minutes"),
        allowed.cast("bigint").alias("allowed_minutes"),
    ).withColumn("minutes_over", F.col("elapsed_minutes") - F.col("allowed_minutes"))
    return report.filter(F.col("minutes_over") > 0)


def order_counts(orders: DataFrame, by: str = "status") -> DataFrame:
    return orders.groupBy(by).agg(F.count(F.lit(1)).alias("n_orders"))


def incomplete_cycles(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders whose events do not form a cycle, with the reason."""
    kind = F.col("event_type")
    per_order = events.groupBy("order_id").agg(
        F.min(F.when(kind == "cycle_started", F.col("event_time"))).alias("started_at"),
        F.max(F.when(kind == "cycle_confirmed", F.col("event_time"))).alias("confirmed_at"),
        F.max(F.when(kind == "cycle_aborted", F.col("event_time"))).alias("aborted_at"),
    )
    joined = per_order.join(orders.select("order_id", "status"), "order_id", "full_outer")
    started, confirmed, aborted = F.col("started_at"), F.col("confirmed_at"), F.col("aborted_at")
    reason = (
        F.when(confirmed.isNotNull() & started.isNull(), "confirmed_without_start")
        .when(confirmed < started, "end_before_start")
        .when(started.isNotNull() & confirmed.isNull() & aborted.isNull(), "started_without_end")
        .when((F.col("status") == "CONFIRMED") & confirmed.isNull() & started.isNull(), "confirmed_without_events")
    )
    return joined.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "order_id", "status", "started_at", "confirmed_at", "reason"
    )


def document_numbers(documents: DataFrame, column: str, slice_numbers: int = 100_000) -> DataFrame:
    """Gaps and repeats in CONF-YYYY-NNNNN or GR-YYYY-NNNNNN numbers, per kind and year."""
    pattern = r"^(CONF|GR)-(\d{4})-(\d+)$"
    part = lambda i: F.regexp_extract(column, pattern, i)
    numbers = documents.filter(F.col(column).rlike(pattern)).select(
        part(1).alias("kind"), part(2).cast("int").alias("year"), part(3).cast("bigint").alias("number")
    )
    counted = numbers.groupBy("kind", "year", "number").agg(F.count(F.lit(1)).alias("n_documents"))
    series = OrderedSeries(counted, ["kind", "year"], ["number"], slice_numbers, numeric=True)
    steps = series.with_previous(_previous="number")
    gaps = steps.filter(F.col("number") - F.col("_previous") > 1).select(
        "kind", "year", F.lit("gap").alias("issue"), (F.col("_previous") + 1).alias("first_number"),
        (F.col("number") - 1).alias("last_number"), (F.col("number") - F.col("_previous") - 1).alias("n"),
    )
    repeats = counted.filter("n_documents > 1").select(
        "kind", "year", F.lit("duplicate").alias("issue"), F.col("number").alias("first_number"),
        F.col("number").alias("last_number"), F.col("n_documents").alias("n"),
    )
    return gaps.unionByName(repeats)


def overlapping_cycles(cycles: DataFrame, slice_days: int = 30) -> DataFrame:
    """Cycles started on an oven whose earlier cycles had not all ended. Takes order_id, oven_id,
    cycle_start_time and cycle_end_time (null: still open)."""
    open_end = F.coalesce("cycle_end_time", F.lit("9999-12-31").cast("timestamp"))
    series = OrderedSeries(
        cycles.filter(F.col("cycle_start_time").isNotNull()), ["oven_id"], ["cycle_start_time", "order_id"],
        slice_days * 1440,
    )
    busy = series.with_extreme("busy_until", open_end, "max", inclusive=False)
    return busy.filter(F.col("busy_until") > F.col("cycle_start_time"))
