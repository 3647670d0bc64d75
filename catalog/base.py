"""Registry of checked queries, and the frames several of them start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordflow.operators.reshape import wide_to_eav
from recordflow.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """A query and the SQL it must agree with (none where SQL cannot say it)."""

    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None) -> Callable[[Run], Run]:
    """Register a query under its function name."""

    def register(run: Run) -> Run:
        ENTRIES[run.__name__] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; local timestamps are read as UTC."""
    df = configure(spark).read.parquet(f"{sf}/{name}.parquet")
    local = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df


def text(column: str) -> Column:
    return F.col(column).cast("string")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
DAY = "strftime({}, '%Y-%m-%d')"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"


def iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# ---------------------------------------------------------------- customers, long layout


def customer_eav(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").select(
        text("c_custkey").alias("record"),
        "c_name",
        text("c_nationkey").alias("c_nationkey"),
        money("c_acctbal").alias("c_acctbal"),
        "c_mktsegment",
    )
    return wide_to_eav(wide, ["record"])


CUSTOMER_EAV = f"""
  SELECT CAST(c_custkey AS VARCHAR) AS record, 'c_name' AS field_name, c_name AS value FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_acctbal', {MONEY.format('c_acctbal')} FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_mktsegment', c_mktsegment FROM customer
"""


# ---------------------------------------------------------------- events, long layout


def event_eav(spark: SparkSession, sf: str) -> DataFrame:
    """One fact per event: record = user, field = event type."""
    return table(spark, sf, "events").select(
        text("user_id").alias("record"),
        F.col("event_type").alias("field_name"),
        money("value").alias("value"),
        F.concat(F.lit("day_"), F.date_format("ts", "dd")).alias("redcap_event_name"),
        "event_id",
    )


EVENT_EAV = f"""
  SELECT CAST(user_id AS VARCHAR) AS record, event_type AS field_name,
         {MONEY.format('value')} AS value, 'day_' || strftime(ts, '%d') AS redcap_event_name, event_id
  FROM events
"""


# ---------------------------------------------------------------- orders, wide, and an older state


def orders_flat(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        text("o_orderkey").alias("record_id"),
        F.lit("order_arm_1").alias("redcap_event_name"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("price"),
        day("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("priority"),
    )


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """An older state: finished orders unchanged, open ones at another price, pending ones absent."""
    dearer = (F.col("price").cast("decimal(18,2)") + 1).cast("string")
    return (
        orders_flat(spark, sf)
        .where(F.col("status") != "P")
        .withColumn("price", F.when(F.col("status") == "O", dearer).otherwise(F.col("price")))
    )


ORDERS_FLAT = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'order_arm_1' AS redcap_event_name,
         o_orderstatus AS status, {MONEY.format('o_totalprice')} AS price,
         {DAY.format('o_orderdate')} AS day, o_orderpriority AS priority
  FROM orders
"""
SNAPSHOT = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'order_arm_1' AS redcap_event_name,
         o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'O'
              THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS VARCHAR)
              ELSE {MONEY.format('o_totalprice')} END AS price,
         {DAY.format('o_orderdate')} AS day, o_orderpriority AS priority
  FROM orders WHERE o_orderstatus <> 'P'
"""


# ---------------------------------------------------------------- line items as text


def items_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("record_id"),
        text("l_linenumber").alias("redcap_repeat_instance"),
        text("l_partkey").alias("l_partkey"),
        text("l_suppkey").alias("l_suppkey"),
        money("l_quantity").alias("l_quantity"),
        money("l_extendedprice").alias("l_extendedprice"),
        money("l_discount").alias("l_discount"),
        money("l_tax").alias("l_tax"),
        "l_returnflag",
        "l_linestatus",
        day("l_shipdate").alias("l_shipdate"),
    )


ITEMS_TEXT = f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS record_id, CAST(l_linenumber AS VARCHAR) AS redcap_repeat_instance,
         CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
         {MONEY.format('l_quantity')} AS l_quantity, {MONEY.format('l_extendedprice')} AS l_extendedprice,
         {MONEY.format('l_discount')} AS l_discount, {MONEY.format('l_tax')} AS l_tax,
         l_returnflag, l_linestatus, {DAY.format('l_shipdate')} AS l_shipdate
  FROM lineitem
"""


def hash_sql(columns: list[str]) -> str:
    """Content hash of the columns, as `table_hash` forms it."""
    cells = " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in sorted(columns))
    digits = f"CAST('0x' || substr(md5({cells}), 1, 15) AS BIGINT)"
    total = f"CAST(sum(CAST({digits} AS HUGEINT)) AS VARCHAR)"
    return f"substr(md5(CAST(count(*) AS VARCHAR) || ':' || {total}), 1, 12)"


# ---------------------------------------------------------------- intake records


def intake_eav(spark: SparkSession, sf: str) -> DataFrame:
    """Intake-like long table: a record per order, its line items as repeat instances."""
    nothing = F.lit(None)
    ids = ["record", "redcap_event_name", "redcap_repeat_instrument", "redcap_repeat_instance"]
    status = F.col("o_orderstatus")
    single = table(spark, sf, "orders").select(
        text("o_orderkey").alias("record"),
        F.lit("order_arm_1").alias("redcap_event_name"),
        nothing.cast("string").alias("redcap_repeat_instrument"),
        nothing.cast("int").alias("redcap_repeat_instance"),
        text("o_orderkey").alias("record_id"),
        text("o_custkey").alias("mrn"),
        day("o_orderdate").alias("dob"),
        F.when(status == "F", "0").when(status == "O", "1").otherwise("3").alias("guardian2_consent"),
        F.when(status == "O", "1").alias("permission_audiovideo_1113"),
        F.when(status == "P", "2").alias("parent_second_guardian_consent_complete"),
        F.when(status == "P", "0").otherwise("1").alias("intake_ready"),
        money("o_totalprice").alias("price"),
    )
    repeated = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("record"),
        F.lit("item_arm_1").alias("redcap_event_name"),
        F.col("l_returnflag").alias("redcap_repeat_instrument"),
        F.col("l_linenumber").cast("int").alias("redcap_repeat_instance"),
        F.col("l_quantity").cast("int").cast("string").alias("permission_collab_1821"),
        text("l_partkey").alias("phone_1821"),
        text("l_suppkey").alias("supplier"),
    )
    return wide_to_eav(single, ids).unionByName(wide_to_eav(repeated, ids))


def _cells(source: str, ids: str, cells: dict[str, str]) -> str:
    parts = [
        f"SELECT {ids}, '{name}' AS field_name, {value} AS value FROM {source} WHERE {value} IS NOT NULL"
        for name, value in cells.items()
    ]
    return "\n  UNION ALL ".join(parts)


INTAKE_EAV = "\n  UNION ALL ".join(
    [
        _cells(
            "orders",
            "CAST(o_orderkey AS VARCHAR) AS record, 'order_arm_1' AS redcap_event_name, "
            "CAST(NULL AS VARCHAR) AS redcap_repeat_instrument, CAST(NULL AS INTEGER) AS redcap_repeat_instance",
            {
                "record_id": "CAST(o_orderkey AS VARCHAR)",
                "mrn": "CAST(o_custkey AS VARCHAR)",
                "dob": DAY.format("o_orderdate"),
                "guardian2_consent": "CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '3' END",
                "permission_audiovideo_1113": "CASE WHEN o_orderstatus = 'O' THEN '1' END",
                "parent_second_guardian_consent_complete": "CASE WHEN o_orderstatus = 'P' THEN '2' END",
                "intake_ready": "CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' END",
                "price": MONEY.format("o_totalprice"),
            },
        ),
        _cells(
            "lineitem",
            "CAST(l_orderkey AS VARCHAR), 'item_arm_1', l_returnflag, CAST(l_linenumber AS INTEGER)",
            {
                "permission_collab_1821": "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)",
                "phone_1821": "CAST(l_partkey AS VARCHAR)",
                "supplier": "CAST(l_suppkey AS VARCHAR)",
            },
        ),
    ]
)

AS_OF = "2012-06-15"
AGE = (
    f"(date_part('year', DATE '{AS_OF}') - date_part('year', CAST({{0}} AS DATE)) - "
    f"CASE WHEN '{AS_OF[5:7]}{AS_OF[8:]}' < strftime(CAST({{0}} AS DATE), '%m%d') THEN 1 ELSE 0 END)"
)
