"""Adding ``battery_level`` to BATTERY events, in both forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.operators.documents import has_event
from pedalflow.sources import changes

BATTERY = "BATTERY"
FIELD = "battery_level"
DEFAULT_LEVEL = 50
LOW, HIGH = 0, 100


def add_column(df: DataFrame, name: str = FIELD, type_name: str = "int") -> DataFrame:
    """Add a nullable column; a table that has it stays as it is."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(type_name))


def violates_range(level: Column) -> Column:
    return level.isNotNull() & ~level.between(LOW, HIGH)


def out_of_range(events: DataFrame) -> DataFrame:
    """Rows that break the rule "no level, or 0 to 100"."""
    return events.filter(violates_range(F.col(FIELD)))


def checked(events: DataFrame) -> DataFrame:
    """The same rows; a job that reads a level out of range fails."""
    level = F.col(FIELD)
    failure = F.raise_error(F.concat(F.lit(f"{FIELD} out of range: "), level.cast("string"))).cast("int")
    return events.withColumn(FIELD, F.when(violates_range(level), failure).otherwise(level))


def _lacks_level() -> Column:
    return (F.col("type") == BATTERY) & F.col(FIELD).isNull()


def missing_level(events: DataFrame) -> DataFrame:
    """BATTERY events without a level."""
    return events.filter(_lacks_level())


def add_battery_level(events: DataFrame) -> DataFrame:
    """Add the column, give BATTERY events without a level the default and enforce the range."""
    evolved = add_column(events)
    level = F.when(
        F.col("type") == BATTERY, F.coalesce(F.col(FIELD), F.lit(DEFAULT_LEVEL))
    ).otherwise(F.col(FIELD))
    return checked(evolved.withColumn(FIELD, level))


def update_stored(spark: SparkSession, folder: str, schema: T.StructType, by: str) -> list:
    """Give the BATTERY events without a level, in a table stored in parts by ``by``, the default; the parts rewritten."""
    return changes.update_where(spark, folder, schema, by, _lacks_level(), {FIELD: F.lit(DEFAULT_LEVEL)})


def add_battery_level_docs(docs: DataFrame) -> DataFrame:
    """Set the level of every BATTERY element, whether it had one or not; all else in a document stays."""
    return docs.withColumn("events", _with_levels(docs))


def _with_levels(df: DataFrame) -> Column:
    element = df.schema["events"].dataType.elementType
    has_field = FIELD in element.fieldNames()

    def evolve(e: Column) -> Column:
        old = e[FIELD] if has_field else F.lit(None).cast("int")
        return e.withField(FIELD, F.when(e["type"] == BATTERY, F.lit(DEFAULT_LEVEL)).otherwise(old))

    return F.transform("events", evolve)


def evolve_counts(events: DataFrame) -> DataFrame:
    """BATTERY events, those to back-fill and all events, in one pass."""
    battery = F.col("type") == BATTERY
    return add_column(events).agg(
        F.count_if(battery).alias("battery_events"),
        F.count_if(battery & F.col(FIELD).isNull()).alias("backfilled"),
        F.count("*").alias("events"),
    )


def evolve_counts_docs(docs: DataFrame) -> DataFrame:
    """Trips with a BATTERY event, and those among them that the update changes."""
    has_field = FIELD in docs.schema["events"].dataType.elementType.fieldNames()

    def changes(e: Column) -> Column:
        battery = e["type"] == BATTERY
        return battery & ~e[FIELD].eqNullSafe(F.lit(DEFAULT_LEVEL)) if has_field else battery

    return (
        docs.filter(has_event(BATTERY))
        .groupBy("trip_id")
        .agg(F.max(F.exists("events", changes)).alias("changed"))
        .agg(F.count("*").alias("matched"), F.count_if("changed").alias("modified"))
    )


def evolve_sample(events: DataFrame, n: int = 5) -> DataFrame:
    """The first BATTERY events after the change."""
    return (
        add_battery_level(events)
        .filter(F.col("type") == BATTERY)
        .select("event_id", "trip_id", "type", "value", FIELD)
        .orderBy("event_id")
        .limit(n)
    )


def evolve_sample_docs(docs: DataFrame, n: int = 3) -> DataFrame:
    """The BATTERY elements of the first n trips that have one."""
    arrays = add_battery_level_docs(docs).filter(has_event(BATTERY))
    first = arrays.select("trip_id").distinct().orderBy("trip_id").limit(n)
    elements = F.filter("events", lambda e: e["type"] == BATTERY)
    return (
        arrays.join(F.broadcast(first), "trip_id", "left_semi")
        .select("trip_id", F.inline(elements))
        .select("trip_id", "timestamp", "type", "value", FIELD)
    )
