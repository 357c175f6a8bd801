"""The mobility dataset read from the given order tables.

customer = user, supplier = station, order = trip, line item = trip event (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.schemas import Mobility

# Declared, so that opening a table reads no file footer.
GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}

# A ship time and a supplier id share one DECIMAL(38, 0): microseconds, then 64 bits of id. Both are shifted to be
# positive. All ids fit; a time must lie within some 77,000 years of 1970, else the job fails.
_TIME_SHIFT, _TIME_LIMIT = 2_500_000_000_000_000_000, 5_000_000_000_000_000_000
_ID_SHIFT, _ID_SPAN = 1 << 63, 1 << 64
_DAY = 86_400_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 14600).cast("int")).alias("birthdate"),
        F.col("n_name").alias("country"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        (F.col("s_suppkey") % 41 + 10).cast("int").alias("capacity"),
    )


def microseconds(time: str) -> Column:
    """Microseconds since 1970 of a time without zone; no session zone is involved."""
    t = F.col(time)
    day = F.unix_date(t.cast("date")).cast("bigint") * _DAY
    clock = F.hour(t) * 3600 + F.minute(t) * 60
    return day + clock.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def pack(time: str, station: str) -> Column:
    """One number that orders by time, then by station; it fails for a time out of range."""
    shifted = microseconds(time) + _TIME_SHIFT
    sound = shifted.between(0, _TIME_LIMIT)
    checked = F.when(sound | F.col(time).isNull(), shifted).otherwise(
        F.raise_error(F.concat(F.lit("time out of range: "), F.col(time).cast("string"))).cast("bigint")
    )
    return checked.cast("decimal(20,0)") * _whole(_ID_SPAN) + (F.col(station).cast("decimal(20,0)") + _whole(_ID_SHIFT))


def packed_station(packed: str) -> Column:
    return (F.col(packed) % _whole(_ID_SPAN) - _whole(_ID_SHIFT)).cast("bigint")


def packed_time(packed: str) -> Column:
    whole = F.expr(f"{packed} div {_ID_SPAN}BD") - _TIME_SHIFT
    day = F.floor(whole / F.lit(_DAY).cast("decimal(20,0)")).cast("int")
    seconds = ((whole - day.cast("bigint") * _DAY).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.date_from_unix_date(day).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """A trip runs from an order's first shipment to its last (same time: lowest / highest supplier).

    Time and supplier are packed into one number, so that min and max stay in a hash aggregate
    with map-side combine; a struct would force a sort of every line item.
    """
    packed = pack("l_shipdate", "l_suppkey")
    ends = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(packed).alias("first"), F.max(packed).alias("last"))
    )
    return table(spark, folder, "orders").join(ends, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("user_id"),
        packed_station("first").alias("start_station_id"),
        packed_station("last").alias("end_station_id"),
        packed_time("first").alias("start_time"),
        packed_time("last").alias("end_time"),
        F.col("o_totalprice").alias("total_cost"),
    )


def trip_events(spark: SparkSession, folder: str) -> DataFrame:
    """One event per line item.

    Line items have no id of their own. The event id is their natural key as text: unique
    without numbering the lines of an order, which would put a large order in one task.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", microseconds("l_shipdate")).alias("event_id"),
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.when((flag == "R") & (status == "F"), "ERROR")
        .when(flag == "R", "DELAY")
        .when(flag == "A", "GPS")
        .otherwise("BATTERY")
        .alias("type"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%")).alias("value"),
    )


def load(spark: SparkSession, folder: str) -> Mobility:
    return Mobility(
        users(spark, folder), stations(spark, folder), trips(spark, folder), trip_events(spark, folder)
    )
