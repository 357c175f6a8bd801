"""Tables that are written only if they keep their declared rules.

Rules are the columns' types: CHAR lengths and NOT NULL, a range, a key and references. They are counted by ``observe`` while
the rows are written to a folder of their own, in the same pass; keys and references, which need other rows, are looked up in
what was written, reading these columns alone. Only then the folder takes the place of the old table. A write
that breaks a rule fails, says which, and leaves the old table as it was.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.operators.quality import duplicate_keys, missing_targets
from pedalflow.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, Mobility
from pedalflow.sources.folders import delete, publish
from pedalflow.sources.storage import conform

# --- fixed values: the declared lengths of texts ---
LENGTHS = {
    "users": {"name": 50, "surname": 50, "country": 50},
    "stations": {"name": 100, "city": 50},
    "trips": {},
    "events": {"type": 20},
}
# --- end of fixed values ---
NULLABLE = {name: [column for table, column in FOREIGN_KEYS if table == name] for name in TABLES}


@dataclass(frozen=True)
class Rules:
    """What the rows of a table must keep: ``ranges`` has the lowest and highest value of a column that may be null."""

    key: str
    not_null: list[str]
    lengths: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    def counts(self) -> dict[str, Column]:
        """For each rule on a row's own values, the rows that break it."""
        broken = {f"null_{c}": F.col(c).isNull() for c in self.not_null}
        broken |= {f"long_{c}": F.length(c) > n for c, n in self.lengths.items()}
        broken |= {f"range_{c}": ~F.col(c).between(*ends) for c, ends in self.ranges.items()}
        return {name: F.count_if(condition) for name, condition in broken.items()}


def rules_of(name: str, schema: T.StructType) -> Rules:
    """The declared rules of one of the four tables; references may be null, a battery level is null or 0 to 100."""
    not_null = [c for c in schema.names if c not in NULLABLE[name] and c != "battery_level"]
    ranges = {"battery_level": (0, 100)} if "battery_level" in schema.names else {}
    return Rules(PRIMARY_KEYS[name], not_null, LENGTHS[name], ranges)


class RuleError(ValueError):
    """The rules that were broken, with the number of rows or keys."""

    def __init__(self, folder: str, broken: dict[str, int]):
        super().__init__(f"{folder}: " + ", ".join(f"{rule}: {n}" for rule, n in broken.items()))
        self.broken = broken


def write_checked(
    df: DataFrame, rules: Rules, folder: str, references: dict[str, tuple[DataFrame, str]] | None = None
) -> int:
    """Replace ``folder`` with ``df``, or raise ``RuleError``; gives the number of rows. ``references`` has for a column the
    table and the key that its values must be found in."""
    spark = df.sparkSession
    staged, seen = f"{folder}.new", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[n.alias(c) for c, n in rules.counts().items()]).write.mode("overwrite").parquet(staged)
    found = dict(seen.get)
    rows = found.pop("rows")
    broken = {rule: n for rule, n in found.items() if n}
    if not broken:
        written = spark.read.schema(df.schema).parquet(staged)
        broken |= _counted(f"duplicate_{rules.key}", duplicate_keys(written, rules.key))
        for column, (target, key) in (references or {}).items():
            broken |= _counted(f"unknown_{column}", missing_targets(written, column, target, key))
    if broken:
        delete(spark, staged)
        raise RuleError(folder, broken)
    publish(spark, staged, folder)
    return rows


def _counted(rule: str, keys: DataFrame) -> dict[str, int]:
    n = keys.count()
    return {rule: n} if n else {}


def write_all_checked(data: Mobility, folder: str, schemas: dict[str, T.StructType] = TABLES) -> dict[str, int]:
    """Replace the four tables, each after those that it refers to; the first that breaks a rule stops the rest."""
    spark, rows = data.users.sparkSession, {}
    for name, df in data._asdict().items():
        references = {
            column: (read_checked(spark, folder, target, schemas), PRIMARY_KEYS[target])
            for (table, column), target in FOREIGN_KEYS.items()
            if table == name
        }
        rows[name] = write_checked(conform(df, schemas[name]), rules_of(name, schemas[name]), f"{folder}/{name}", references)
    return rows


def read_checked(spark: SparkSession, folder: str, name: str, schemas: dict[str, T.StructType] = TABLES) -> DataFrame:
    return spark.read.schema(schemas[name]).parquet(f"{folder}/{name}")


def rule_report(df: DataFrame, name: str, rules: Rules) -> DataFrame:
    """``(table_name, rule, broken)`` for each rule on a row's own values and for the key, without writing."""
    counts = rules.counts()
    per_rule = df.agg(*[n.alias(c) for c, n in counts.items()]).unpivot([], list(counts), "rule", "broken")
    keys = duplicate_keys(df, rules.key).agg(F.count("*").alias("broken")).select(F.lit(f"duplicate_{rules.key}").alias("rule"), "broken")
    return per_rule.unionByName(keys).select(F.lit(name).alias("table_name"), "rule", "broken")
