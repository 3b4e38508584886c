"""The shop tables as catalog tables: t_member, t_order and so on in a database.

A table may be partitioned by the day (`dt`, yyyy-MM-dd) or the month (`month`, yyyy-MM) of its
`create_time`. Time bounds of the reports then also bound the partition column (see
`operators.daily.time_window`), so that a report over a week lists and reads the partitions of
that week, and the bound on the time itself reaches the files.

Every table is checked when it is first used: a missing or ill-typed column is named in the error,
before any job runs. Additional columns are let through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.daily import PARTITION_FORMAT, PARTITION_OF
from .tables import ShopTables

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)
_MONEY = (T.DecimalType, *_WHOLE)
_ANY = (T.DataType,)

# Columns that the operators read, and the types that they take.
REQUIRED: dict[str, dict[str, tuple]] = {
    "t_member": {"id": _WHOLE, "phone": (T.StringType,), "sex": _ANY, "member_channel": _ANY,
                 "mp_open_id": (T.StringType,), "address_default_id": _ANY, "create_time": _TIME},
    "t_order": {"order_id": _WHOLE, "member_id": _WHOLE, "order_status": _WHOLE,
                "origin_price": _MONEY, "pay_price": _MONEY, "create_time": _TIME},
    "t_order_commodity": {"order_id": _WHOLE, "commodity_id": _WHOLE},
    "t_coupon": {"id": _WHOLE, "coupon_price": _MONEY},
    "t_coupon_member": {"member_id": _WHOLE, "coupon_id": _WHOLE, "coupon_channel": _WHOLE,
                        "create_time": _TIME},
    "t_delivery": {"member_id": _WHOLE, "pick_time": _TIME, "arrive_time": _TIME},
    "t_feedback": {"id": _WHOLE, "member_id": _WHOLE, "feedback_type": _ANY},
}
# Partition columns, how Spark writes their values and how Python does.
FORMATS = {"dt": ("yyyy-MM-dd", "%Y-%m-%d"), "month": ("yyyy-MM", "%Y-%m")}


def checked(df: DataFrame, table: str) -> DataFrame:
    """The frame, if it has the columns that the operators read."""
    faults = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, kinds in REQUIRED[table].items():
        if name not in types:
            faults.append(f"no column {name}")
        elif not isinstance(types[name], kinds):
            faults.append(f"{name} is {types[name].simpleString()}")
    if faults:
        raise ValueError(f"table {table}: {', '.join(faults)}")
    return df


class CatalogTables(ShopTables):
    """The shop tables of a catalog database."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark, database)
        self.database = database

    def _table(self, name: str) -> DataFrame:
        if name not in self._raw:
            df = checked(self.spark.table(f"{self.database}.{name}"), name)
            split = {c.name for c in self.spark.catalog.listColumns(f"{self.database}.{name}")
                     if c.isPartition and c.name in FORMATS}
            # Only a real partition column is marked, not a column that happens to have its name.
            self._raw[name] = df.select(*(
                F.col(c).alias(c, metadata={PARTITION_OF: "create_time",
                                            PARTITION_FORMAT: FORMATS[c][1]}) if c in split
                else F.col(f"`{c}`") for c in df.columns))
        return self._raw[name]

    def raw(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    member = property(lambda self: self._table("t_member"))
    order = property(lambda self: self._table("t_order"))
    order_commodity = property(lambda self: self._table("t_order_commodity"))
    coupon = property(lambda self: self._table("t_coupon"))
    coupon_member = property(lambda self: self._table("t_coupon_member"))
    delivery = property(lambda self: self._table("t_delivery"))
    feedback = property(lambda self: self._table("t_feedback"))


def write_tables(t: ShopTables, database: str, by: str = "dt", location: str | None = None,
                 names: list[str] | None = None) -> None:
    """Write shop tables to a database, those with a `create_time` partitioned by its day (`dt`)
    or month (`month`). A rerun replaces the tables."""
    if by not in FORMATS:
        raise ValueError(f"partition by one of {sorted(FORMATS)}, not {by!r}")
    at = f" LOCATION '{location}'" if location else ""
    t.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name in names or REQUIRED:
        df = checked(getattr(t, name.removeprefix("t_")), name)
        if "create_time" in df.columns:
            df = df.withColumn(by, F.date_format("create_time", FORMATS[by][0]))
            # A partition's rows come together; a large partition still takes several files.
            (df.hint("rebalance", by).write.mode("overwrite").format("parquet")
             .partitionBy(by).saveAsTable(f"{database}.{name}"))
        else:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
