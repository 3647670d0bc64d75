"""Queries: dictionary checks, error texts, ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import ITEMS_TEXT, hash_sql, items_text, query, table, text
from recordflow.operators import dedup, ledger, quality
from recordflow.schemas import FIELD
from recordflow.sources import scan


def _fields(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Facts named by type and brand of parts; the dictionary knows those of larger parts."""
    part = table(spark, sf, "part")
    name = F.when(F.col("p_size") == 1, "mrn").otherwise(F.concat("p_type", F.lit("_"), "p_brand"))
    eav = part.select(text("p_partkey").alias("record"), name.alias(FIELD), F.col("p_name").alias("value"))
    dictionary = part.where("p_size > 40").select(
        F.concat("p_type", F.lit("_"), "p_brand").alias(FIELD),
        F.concat(F.lit("form_"), "p_type").alias("form_name"), F.lit("text").alias("field_type"),
    )
    return eav, dictionary


PART_FACTS = """
  SELECT CAST(p_partkey AS VARCHAR) AS record, CASE WHEN p_size = 1 THEN 'mrn' ELSE p_type || '_' || p_brand END AS field_name,
         p_name AS value FROM part
"""
PART_FIELDS = "SELECT p_type || '_' || p_brand FROM part WHERE p_size > 40"


@query(f"SELECT * FROM ({PART_FACTS}) WHERE field_name = 'mrn' OR field_name IN ({PART_FIELDS})")
def known_fields(spark: SparkSession, sf: str) -> DataFrame:
    return quality.known_fields(*_fields(spark, sf))[0]


@query(f"SELECT DISTINCT field_name FROM ({PART_FACTS}) WHERE field_name <> 'mrn' AND field_name NOT IN ({PART_FIELDS})")
def unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    return quality.known_fields(*_fields(spark, sf))[1]


@query("SELECT DISTINCT p_type || '_' || p_brand AS field_name FROM part WHERE p_size > 40 AND p_type IN ('ECONOMY', 'STANDARD')")
def dictionary_scan(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = _fields(spark, sf)[1]
    return scan.dictionary_of(dictionary, ["form_ECONOMY", "form_STANDARD"]).select(FIELD).distinct()


@query(f"""
WITH t AS ({ITEMS_TEXT})
SELECT 'l_partkey,l_suppkey,l_tax' AS unknown, count(*) AS row_count,
  {hash_sql(["record_id", "redcap_repeat_instance", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate", "lines_complete"])}
  AS content_hash FROM (SELECT *, l_linestatus AS lines_complete FROM t)
""")
def column_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary lists the columns whose name occurs among the items' own flag letters."""
    items = items_text(spark, sf).withColumn("lines_complete", F.col("l_linestatus"))
    listed = F.when(F.col("l_returnflag") == "A", F.array(*map(F.lit, ["l_quantity", "l_extendedprice", "l_discount"])))
    listed = listed.otherwise(F.array(*map(F.lit, ["l_returnflag", "l_linestatus", "l_shipdate"])))
    dictionary = items.select(F.explode(listed).alias(FIELD)).distinct()
    kept, unknown = quality.column_gate(items, dictionary, "Lines")
    return dedup.table_hash(kept).select(F.lit(",".join(sorted(unknown))).alias("unknown"), "row_count", "content_hash")


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a target system: unknown fields for finished orders, bad categories for open ones."""
    order = text("o_orderkey")
    fields = F.concat(
        F.lit("Error\nThe following fields were not found in the project as real data fields: f_"), order,
        F.lit(" , "), "o_orderpriority", F.lit("  ,  end\nmore, text"),
    )

    def bad(field, value):
        return F.concat(
            F.lit('"'), order, F.lit('","'), field, F.lit('","'), value,
            F.lit('","The value is not a valid category for '), field, F.lit('"\n'),
        )

    category = F.concat(bad(F.lit("priority"), F.col("o_orderpriority")), bad(F.lit("empty"), F.lit("")))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", fields).when(F.col("o_orderstatus") == "O", category)
        .otherwise("Gateway timeout").alias("error"),
    )


@query("""
SELECT o_orderkey, 'f_' || o_orderkey AS field_name FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'end' FROM orders WHERE o_orderstatus = 'F'
""")
def error_fields(spark: SparkSession, sf: str) -> DataFrame:
    return quality.error_fields(_errors(spark, sf)).drop("error")


@query("""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS record, 'priority' AS field_name, o_orderpriority AS value,
       'The value is not a valid category for priority' AS error_message FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'empty', '', 'The value is not a valid category for empty'
FROM orders WHERE o_orderstatus = 'O'
""")
def error_categories(spark: SparkSession, sf: str) -> DataFrame:
    return quality.error_categories(_errors(spark, sf))


def _names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Names seen on the last day, and the log of all names by day."""
    name = F.concat("event_type", F.lit("_"), text("user_id"))
    seen = table(spark, sf, "events").select(name.alias(FIELD), F.to_date("ts").alias("day"), "value")
    names = seen.where("day = DATE '2024-01-30'")
    log = seen.where("day < DATE '2024-01-30' OR value > 60").select(FIELD, "day").distinct()
    return quality.new_today(names, log, "2024-01-30")


SEEN = "SELECT event_type || '_' || user_id AS field_name, CAST(ts AS DATE) AS day, value FROM events"
NEW_NAMES = f"""
  SELECT DISTINCT field_name FROM ({SEEN}) WHERE day = DATE '2024-01-30'
  EXCEPT SELECT field_name FROM ({SEEN}) WHERE day = DATE '2024-01-30' AND value > 60
"""


@query(NEW_NAMES)
def new_today(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf)[0]


@query(f"""
SELECT field_name, CAST(day AS VARCHAR) AS day FROM (
  SELECT DISTINCT field_name, day FROM ({SEEN}) WHERE (day < DATE '2024-01-30' OR value > 60) AND day >= DATE '2024-01-23')
UNION ALL SELECT field_name, '2024-01-30' FROM ({NEW_NAMES})
""")
def name_log(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf)[1].select(FIELD, text("day").alias("day"))


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'created' WHEN 'click' THEN 'exists' WHEN 'purchase' THEN 'exists'
       ELSE 'error' END AS outcome FROM events
""")
def outcome_class(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "view", 200).when(kind == "click", 422).when(kind == "error", 500).otherwise(400)
    message = F.when(kind == "purchase", "Non-unique value.").when(kind == "signup", "Bad e-mail.")
    return table(spark, sf, "events").select("event_id", quality.outcome_class(status, message).alias("outcome"))


# ---------------------------------------------------------------- ledger


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is an entry for its user; errors take the user out."""
    removed = F.when(F.col("event_type") == "error", F.create_map(F.lit("removed"), F.lit("true")))
    return table(spark, sf, "events").select(
        F.lit("users").alias("ledger"), text("user_id").alias("key"), F.col("ts").alias("processed_at"),
        F.coalesce(removed, F.create_map(F.lit("type"), F.col("event_type"))).alias("metadata"),
    )


CURRENT = """
  SELECT user_id, max(ts) AS processed_at, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id
"""
LIVE = f"""
  SELECT * FROM ({CURRENT}) WHERE event_type <> 'error' AND processed_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 MINUTE
"""


@query(f"SELECT CAST(user_id AS VARCHAR) AS key, event_type AS type FROM ({CURRENT}) WHERE event_type <> 'error'")
def ledger_current(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.current(log(spark, sf)).select("key", F.col("metadata")["type"].alias("type"))


@query(f"SELECT event_id, CAST(user_id AS VARCHAR) AS cache_key FROM events WHERE user_id NOT IN (SELECT user_id FROM ({LIVE}))")
def ledger_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", text("user_id").alias("cache_key"))
    return ledger.unprocessed(rows, log(spark, sf), "users", "2024-01-31T00:00:00", 720)


@query(f"""
SELECT 'users' AS ledger, count(*) AS entries, strftime(min(processed_at), '%Y-%m-%d %H:%M:%S') AS oldest,
       strftime(max(processed_at), '%Y-%m-%d %H:%M:%S') AS newest FROM ({LIVE})
""")
def ledger_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ledger.stats(log(spark, sf), "2024-01-31T00:00:00", 720)
    return stats.select(
        "ledger", "entries", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("oldest", "newest")]
    )
