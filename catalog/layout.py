"""Queries: layouts, field and column selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import (
    CUSTOMER_EAV, DAY, EVENT_EAV, ITEMS_TEXT, MONEY, customer_eav, day, event_eav, hash_sql,
    items_text, money, query, table, text,
)
from recordflow.functions.nested import camel_case
from recordflow.operators import dedup, reshape, select
from recordflow.sources import scan


@query(f"""
SELECT c_custkey, 'c_name' AS field_name, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'c_acctbal', {MONEY.format('c_acctbal')} FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def eav_from_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").withColumns(
        {
            "c_acctbal": F.col("c_acctbal").cast("decimal(18,2)"),
            "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        }
    )
    return reshape.wide_to_eav(wide, ["c_custkey"])


@query(f"""
WITH eav AS ({CUSTOMER_EAV})
SELECT record, max(CASE WHEN field_name = 'c_name' THEN value END) AS c_name,
       max(CASE WHEN field_name = 'c_acctbal' THEN value END) AS c_acctbal,
       max(CASE WHEN field_name = 'c_mktsegment' THEN value END) AS c_mktsegment
FROM eav GROUP BY record
""")
def wide_from_eav(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.eav_to_wide(
        customer_eav(spark, sf), ["c_name", "c_acctbal", "c_mktsegment"], order_by=["value"]
    )


@query(f"""
WITH eav AS ({EVENT_EAV})
SELECT record, arg_min(value, event_id) FILTER (field_name = 'click') AS click,
       arg_min(value, event_id) FILTER (field_name = 'purchase') AS purchase
FROM eav WHERE field_name IN ('click', 'purchase') GROUP BY record
""")
def wide_first_event(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.eav_to_wide(event_eav(spark, sf), ["click", "purchase"], order_by=["event_id"])


@query(f"""
WITH eav AS ({EVENT_EAV})
SELECT record, field_name, arg_min(value, event_id) AS value FROM eav GROUP BY record, field_name
""")
def first_values(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_value(event_eav(spark, sf), ["event_id"])


@query(f"""
WITH eav AS ({CUSTOMER_EAV})
SELECT record, CASE field_name WHEN 'c_name' THEN 'full_name' WHEN 'c_mktsegment' THEN 'segment'
               ELSE field_name END AS field_name, value FROM eav
""")
def field_rename(spark: SparkSession, sf: str) -> DataFrame:
    names = {"c_name": "full_name", "c_mktsegment": "segment", "c_unused": "nothing"}
    return select.rename_fields(customer_eav(spark, sf), names)


@query(f"""
WITH eav AS ({CUSTOMER_EAV}),
     copies(old, new) AS (VALUES ('c_name', 'c_name'), ('c_name', 'nickname'), ('c_mktsegment', 'segment'))
SELECT record, coalesce(new, field_name) AS field_name, value FROM eav LEFT JOIN copies ON old = field_name
""")
def field_fanout(spark: SparkSession, sf: str) -> DataFrame:
    copies = {"c_name": ["c_name", "nickname"], "c_mktsegment": ["segment"]}
    return select.fan_out_fields(customer_eav(spark, sf), copies)


@query(f"""
WITH eav AS ({CUSTOMER_EAV})
SELECT * FROM eav WHERE starts_with(field_name, 'c_n') OR starts_with(field_name, 'c_mkt')
""")
def prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    return select.keep_prefixes(customer_eav(spark, sf), ["c_n", "c_name", "c_mkt", "d_"])


@query(f"WITH eav AS ({CUSTOMER_EAV}) SELECT * FROM eav WHERE field_name IN ('c_name', 'c_acctbal')")
def exact_filter(spark: SparkSession, sf: str) -> DataFrame:
    return select.keep_fields(customer_eav(spark, sf), ["c_name", "c_acctbal"])


@query("""
WITH fields AS (SELECT event_type || '_' || user_id || CASE WHEN value > 50 THEN '_received' ELSE '_complete' END
                AS field_name FROM events)
SELECT DISTINCT left(field_name, length(field_name) - 9) AS field_name FROM fields
WHERE suffix(field_name, '_received')
""")
def suffix_fields(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("value") > 50, "_received").otherwise("_complete")
    fields = table(spark, sf, "events").select(
        F.concat("event_type", F.lit("_"), text("user_id"), kind).alias("field_name")
    )
    return select.fields_with_suffix(fields, "_received", strip=True)


@query(f"""
WITH eav AS (SELECT record, field_name, CASE WHEN value IN ('BUILDING', 'MACHINERY') THEN '' ELSE value END AS value
             FROM ({CUSTOMER_EAV}))
SELECT * FROM eav WHERE field_name = 'c_mktsegment'
  AND EXISTS (SELECT 1 FROM eav e WHERE e.record = eav.record AND e.field_name = 'c_mktsegment' AND e.value <> '')
""")
def any_nonempty_long(spark: SparkSession, sf: str) -> DataFrame:
    blank = F.when(F.col("value").isin("BUILDING", "MACHINERY"), "").otherwise(F.col("value"))
    eav = customer_eav(spark, sf).withColumn("value", blank)
    return scan.export_eav(eav, ["c_mktsegment"], match="any")


@query("""
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer
WHERE c_nationkey < 20 AND coalesce(nullif(c_mktsegment, 'BUILDING'), '') <> ''
""")
def any_nonempty_flat(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    return scan.export_flat(
        wide, ["c_mktsegment", "c_phone"], F.col("c_nationkey") < 20, "any", ["c_custkey"]
    )


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def tolerant_select(spark: SparkSession, sf: str) -> DataFrame:
    return scan.tolerant_select(
        table(spark, sf, "customer"), ["c_custkey", "c_name", "c_phone", "c_nationkey"]
    )[0]


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 'customers' AS study FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, 'suppliers' FROM supplier
""")
def multi_source_union(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.lit("customers").alias("study"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("suppliers").alias("study")
    )
    return scan.union_exports(customers, suppliers)


@query("SELECT c_custkey AS record_id, c_name AS full_name, c_nationkey FROM customer")
def rename_wide(spark: SparkSession, sf: str) -> DataFrame:
    names = {"c_custkey": "record_id", "c_name": "full_name", "c_phone": "phone"}
    return select.rename_columns(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), names
    )


@query("""
SELECT event_id, CAST(user_id AS VARCHAR) AS record_id FROM events WHERE event_type <> 'error'
""")
def id_suffix_filter(spark: SparkSession, sf: str) -> DataFrame:
    parent = F.when(F.col("event_type") == "error", "_P").otherwise("")
    rows = table(spark, sf, "events").select(
        "event_id", F.concat(text("user_id"), parent).alias("record_id")
    )
    return select.drop_parent_ids(rows, "intake")


@query(f"""
WITH eav AS ({CUSTOMER_EAV})
SELECT record, max(CASE WHEN field_name = 'c_name' THEN value END) AS "nickname",
       'respondent' AS role, max(CASE WHEN field_name = 'c_mktsegment' THEN value END) AS tag,
       CAST(NULL AS VARCHAR) AS password
FROM eav WHERE field_name IN ('c_name', 'c_mktsegment') GROUP BY record
""")
def individual_frame(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.individual_frame(
        customer_eav(spark, sf),
        {"c_name": "nickname", "c_mktsegment": "tag"},
        {"nickname": None, "role": "respondent", "tag": "Child", "password": None},
    )


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    finished = F.col("o_orderstatus") == "F"
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        text("o_orderkey").alias("record"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("email"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("fname"),
        F.when(finished, F.col("o_orderpriority")).alias("email_2"),
        day("o_orderdate").alias("dob"),
        text("o_custkey").alias("mrn"),
    )


ROLES = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS record,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS email,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS fname,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS email_2,
         {DAY.format('o_orderdate')} AS dob, CAST(o_custkey AS VARCHAR) AS mrn
  FROM orders JOIN customer ON o_custkey = c_custkey
"""
PAIRINGS = [
    reshape.Pairing({"email": "resp_email", "fname": "resp_fname"}, {"dob": "child_dob", "mrn": "mrn"}, "child"),
    reshape.Pairing({"email_2": "resp_email"}, {"dob": "child_dob", "mrn": "mrn"}, "adult"),
    reshape.Pairing({"email_9": "resp_email"}, {"mrn": "mrn"}, "nobody"),
]


@query(f"""
WITH w AS ({ROLES})
SELECT record AS source_record, 0 AS pairing, 'child' AS participant_type, dob AS child_dob, mrn,
       email AS resp_email, fname AS resp_fname FROM w WHERE email IS NOT NULL OR fname IS NOT NULL
UNION ALL SELECT record, 1, 'adult', dob, mrn, email_2, NULL FROM w WHERE email_2 IS NOT NULL
""")
def role_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.role_pairs(_roles(spark, sf), PAIRINGS)


@query("""
WITH users AS (
  SELECT user_id, max(value) FILTER (event_type = 'signup') AS a, max(value) FILTER (event_type = 'view') AS b,
         max(value) FILTER (event_type = 'click') AS c FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN a > 50 THEN CAST(CAST(a AS DECIMAL(18,2)) AS VARCHAR)
                     WHEN b > 50 THEN CAST(CAST(b AS DECIMAL(18,2)) AS VARCHAR)
                     WHEN c > 50 THEN CAST(CAST(c AS DECIMAL(18,2)) AS VARCHAR) END AS email
FROM users
""")
def first_contact(spark: SparkSession, sf: str) -> DataFrame:
    per_user = table(spark, sf, "events").groupBy("user_id").agg(
        *[
            F.max(F.when(F.col("event_type") == kind, F.col("value"))).alias(kind)
            for kind in ("signup", "view", "click")
        ]
    )
    columns = {}
    for i, kind in enumerate(("signup", "view", "click"), 1):
        columns[f"contact.{i}.contactType"] = F.when(F.col(kind) > 50, "email").otherwise("phone")
        columns[f"contact.{i}.information"] = money(kind)
    wide = per_user.withColumns(columns)
    return wide.select("user_id", reshape.first_contact(wide).alias("email"))


_DATA = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]
_KEYS = ["record_id", "redcap_repeat_instance"]


def _chunk_sql(number: int, columns: list[str]) -> str:
    return (
        f"SELECT {number} AS chunk, '{','.join(columns)}' AS columns, count(*) AS row_count, "
        f"{hash_sql(columns)} AS content_hash FROM t"
    )


@query(
    f"WITH t AS ({ITEMS_TEXT}) "
    + " UNION ALL ".join(_chunk_sql(i // 4, _KEYS + _DATA[i : i + 4]) for i in range(0, 9, 4))
)
def column_chunks(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        dedup.table_hash(chunk).select(
            F.lit(i).alias("chunk"), F.lit(",".join(chunk.columns)).alias("columns"), "row_count", "content_hash"
        )
        for i, chunk in enumerate(reshape.column_chunks(items_text(spark, sf), 4))
    ]
    return dedup.union_rows(*parts)


_UNKNOWN = ["l_discount", "l_tax"]


@query(
    f"WITH t AS ({ITEMS_TEXT}) "
    + _chunk_sql(0, _KEYS + [c for c in _DATA if c not in _UNKNOWN])
    + " UNION ALL "
    + _chunk_sql(1, _KEYS + _UNKNOWN)
)
def column_split(spark: SparkSession, sf: str) -> DataFrame:
    sides = reshape.split_columns(items_text(spark, sf), ["l_discount", "l_tax", "l_unheard_of"])
    parts = [
        dedup.table_hash(side).select(
            F.lit(i).alias("chunk"), F.lit(",".join(side.columns)).alias("columns"), "row_count", "content_hash"
        )
        for i, side in enumerate(sides)
    ]
    return dedup.union_rows(*parts)


@query("""
SELECT event_id AS "eventId", event_type AS "eventType", user_id AS "userId", user_id AS "firstId" FROM events
""")
def camel_case_names(spark: SparkSession, sf: str) -> DataFrame:
    nested = table(spark, sf, "events").select(
        "event_id",
        F.struct("event_type", "user_id").alias("event_info"),
        F.array(F.struct(F.col("user_id"))).alias("id_list"),
    )
    named = camel_case(nested)
    return named.select("eventId", "eventInfo.eventType", "eventInfo.userId",
                        F.col("idList")[0]["userId"].alias("firstId"))


@query("""
SELECT c_custkey, c_name, 'en' AS language, CAST(NULL AS VARCHAR) AS password FROM customer
""")
def default_columns(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").select("c_custkey", "c_name")
    return select.with_defaults(wide, {"c_name": "nobody", "language": "en", "password": None})


@query("SELECT c_custkey, c_name FROM customer")
def drop_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    never = F.when(F.col("c_custkey") < 0, "x")
    wide = table(spark, sf, "customer").select("c_custkey", "c_name", never.alias("empty"), "c_nationkey")
    return select.drop_present(select.drop_all_null(wide), ["c_nationkey", "c_phone"])


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name,
       CASE WHEN c_nationkey < 10 THEN c_mktsegment END AS segment FROM customer
WHERE c_mktsegment <> 'BUILDING' OR c_nationkey < 10
""")
def drop_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") < 10, F.col("c_mktsegment")).alias("segment"),
    )
    return select.drop_nulls(wide, "all", ["name", "segment"])


@query("""
SELECT c_custkey AS acc_id_c, c_name AS acc_name_c, c_mktsegment AS acc_child_complete, c_nationkey AS other
FROM customer
""")
def rule_renames(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("acc_child_id"), F.col("c_name").alias("acc_name"),
        F.col("c_mktsegment").alias("acc_child_complete"), F.col("c_nationkey").alias("other"),
    )
    return select.add_suffix(select.strip_infix(wide, "acc_", "child_"), "acc_", "_c")


@query("""
SELECT c_custkey, v AS "accountType" FROM customer, (VALUES ('full'), ('limited')) AS t(v)
""")
def account_variants(spark: SparkSession, sf: str) -> DataFrame:
    return select.expand_variants(table(spark, sf, "customer").select("c_custkey"), "accountType", ["full", "limited"])


@query("SELECT c_custkey, c_name, strftime(DATE '2024-01-31', '%Y-%m-%d') AS modified FROM customer")
def column_fallback(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    modified = select.column_or(customer, ["lastModified", "updatedAt"], F.lit("2024-01-31"))
    name = select.first_present(customer, ["name", "c_name", "c_mktsegment"])
    return customer.select("c_custkey", name, modified.alias("modified"))


@query(f"""
SELECT o_orderkey, o_custkey, {MONEY.format('o_totalprice')} AS price FROM orders ORDER BY o_custkey, o_orderkey LIMIT 25
""")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"))
    return scan.preview(orders, 25, ["o_custkey", "o_orderkey"])


@query(f"WITH eav AS ({CUSTOMER_EAV}) SELECT record, field_name, value FROM eav ORDER BY record, field_name")
def sorted_facts(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.sort_rows(customer_eav(spark, sf), "record", "field_name")
