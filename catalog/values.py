"""Queries: column functions on text, dates, arrays and JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import MONEY, iso, money, query, table, text
from recordflow.functions import dates, nested
from recordflow.functions import text as texts
from recordflow.operators import ledger
from recordflow.plans import alerts, invitations


@query("""
SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
       ELSE CAST(c_custkey AS VARCHAR) END AS padded, 'R' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS responder FROM customer
""")
def pad_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", texts.zero_pad(F.col("c_custkey"), 3).alias("padded"),
        texts.responder_id(F.col("c_custkey")).alias("responder"),
    )


@query("""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS number, '0' || c_name AS name FROM customer
""")
def strip_zeros(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", texts.strip_zeros(F.concat(F.lit("000"), text("c_custkey"))).alias("number"),
        texts.strip_zeros(F.concat(F.lit("0"), "c_name")).alias("name"),
    )


@query("""
SELECT event_id, user_id || ':' || coalesce(nullif(event_type, 'view'), '') || ':' || CASE WHEN value > 50 THEN 1 ELSE 0 END
  AS cache_key FROM events
""")
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        (F.col("value") > 50).alias("high"),
    )
    return texts.with_composite_key(rows, ["user_id", "kind", "high"]).select("event_id", "cache_key")


@query("SELECT event_id, upper(event_type) || '/' || user_id AS cache_key FROM events")
def built_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    keyed = ledger.with_built_key(rows, ["event_type", "user_id"], lambda kind, user: kind.str.upper() + "/" + user.astype(str))
    return keyed.select("event_id", "cache_key")


@query("SELECT doc_id, substr(md5(text), 1, 12) AS twelve, substr(md5(text), 1, 8) AS eight FROM documents")
def short_md5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", texts.short_md5(F.col("text")).alias("twelve"), texts.short_md5(F.col("text"), 8).alias("eight")
    )


@query(r"""
WITH t AS (SELECT doc_id, chr(27) || '[31m' || text || chr(27) || '[0m' || chr(27) || ']0;title' || chr(7) || chr(9) || chr(8232) AS text
           FROM documents)
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '[\r\n]', '', 'g'),
         '\x1B\[[0-9;]*[A-Za-z]|\x1B\][^\x07]*\x07', '', 'g'), '[\p{Cc}\p{Cf}\x{2028}\x{2029}]', '', 'g')) AS clean FROM t
""")
def sanitize(spark: SparkSession, sf: str) -> DataFrame:
    escaped = F.concat(F.lit("\x1b[31m"), "text", F.lit("\x1b[0m\x1b]0;title\x07\t "))
    return table(spark, sf, "documents").select("doc_id", F.md5(texts.sanitize(escaped)).alias("clean"))


@query("SELECT conv_id, turn, length(text) AS n, repeat('█', length(text)) AS mask, '█' AS empty FROM conversations")
def redact(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.char_length("text").cast("bigint").alias("n"),
        texts.redact(F.col("text")).alias("mask"), texts.redact(F.nullif(F.col("text"), F.col("text"))).alias("empty"),
    )


@query(r"""
SELECT page_id, regexp_matches(regexp_extract(url, '//([^/]*)', 1), '^v?\d+\.\d+\.\d+([-+]\w+)?$') AS semver,
  regexp_matches(substr(md5(url), 1, 8) || '-' || substr(md5(url), 9, 4) || '-' || substr(md5(url), 13, 4) || '-' || substr(md5(url), 17, 4)
    || CASE WHEN starts_with(url, 'https') THEN '-' ELSE '' END || substr(md5(url), 21, 12),
    '^[a-zA-Z0-9]{8}-([a-zA-Z0-9]{4}-){3}[a-zA-Z0-9]{12}$') AS id
FROM pages
""")
def pattern_check(spark: SparkSession, sf: str) -> DataFrame:
    digest = F.md5("url")
    dash = F.when(F.col("url").startswith("https"), "-").otherwise("")
    number = F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-"), F.substring(digest, 13, 4),
        F.lit("-"), F.substring(digest, 17, 4), dash, F.substring(digest, 21, 12),
    )
    host = F.regexp_extract("url", "//([^/]*)", 1)
    return table(spark, sf, "pages").select(
        "page_id", texts.matches(host, texts.SEMVER_PATTERN).alias("semver"), texts.matches(number).alias("id")
    )


@query("SELECT event_id, CAST(CASE WHEN event_type = 'view' THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS VARCHAR) AS instance FROM events")
def instance_numbers(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "view", "NaN").otherwise(money("value"))
    return table(spark, sf, "events").select("event_id", texts.to_instance(raw).cast("string").alias("instance"))


@query("""
SELECT event_id, event_type AS instrument FROM events
""")
def strip_complete(spark: SparkSession, sf: str) -> DataFrame:
    number = F.when(F.col("value") > 50, F.concat(F.lit("_"), text("user_id"))).otherwise("")
    field = F.concat("event_type", number, F.lit("_complete"))
    return table(spark, sf, "events").select("event_id", texts.strip_complete(field).alias("instrument"))


# ---------------------------------------------------------------- dates


@query(f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') END AS at,
       strftime(ts, '%Y-%m-%d') AS day FROM events
""")
def iso_ts(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", F.concat(iso("ts"), F.lit("Z")))
        .when(kind == "error", F.concat(iso("ts"), F.lit(" o'clock")))
        .otherwise(iso("ts"))
    )
    return table(spark, sf, "events").select(
        "event_id", F.date_format(dates.iso_timestamp(raw), "yyyy-MM-dd HH:mm:ss.SSS").alias("at"),
        dates.iso_date_part(raw).alias("day"),
    )


@query("SELECT event_id FROM events WHERE event_type = 'view' OR CAST(ts AS DATE) >= DATE '2024-01-19'")
def recent_only(spark: SparkSession, sf: str) -> DataFrame:
    seen = F.when(F.col("event_type") != "view", iso("ts"))
    return table(spark, sf, "events").where(dates.is_recent(seen, "2024-01-20")).select("event_id")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where("event_type = 'view'").select(
        F.lit("views").alias("ledger"), text("event_id").alias("key"), F.col("ts").alias("processed_at"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


@query("""
WITH last AS (SELECT max(ts) AS t FROM events WHERE event_type = 'view')
SELECT event_id FROM events, last WHERE ts BETWEEN
  CASE WHEN t < TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 2 HOUR THEN TIMESTAMP '2024-01-30 12:00:00'
       ELSE TIMESTAMP '2024-01-31 11:58:00' END AND TIMESTAMP '2024-01-31 12:00:00'
""")
def window_pull(spark: SparkSession, sf: str) -> DataFrame:
    window = ledger.recent_window(_log(spark, sf), datetime(2024, 1, 31, 12))
    return ledger.pull(table(spark, sf, "events"), window).select("event_id")


@query("""
WITH l AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT strftime(CASE WHEN max(t) < TIMESTAMP '2024-01-31 00:30:00' - INTERVAL 2 HOUR THEN TIMESTAMP '2024-01-30 00:30:00'
       ELSE TIMESTAMP '2024-01-31 00:28:00' END, '%Y-%m-%d %H:%M:%S') AS window_start, '2024-01-31 00:30:00' AS window_end FROM l
""")
def window_bounds(spark: SparkSession, sf: str) -> DataFrame:
    window = ledger.recent_window(_log(spark, sf), datetime(2024, 1, 31, 0, 30))
    return window.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in window.columns])


# ---------------------------------------------------------------- alert messages


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """An alert message per event; errors have another shape."""
    good = F.concat(
        F.lit('Red: "'), money("value"), F.lit('" to Feeling "tired" to bed Parent_'), "event_type", F.lit("_"),
        text("event_id"),
    )
    bad = F.concat(F.lit("Reminder for "), text("user_id"))
    return table(spark, sf, "events").select(
        text("event_id").alias("id"), text("user_id").alias("secretId"),
        F.when(F.col("event_type") == "error", bad).otherwise(good).alias("message"),
        F.when(F.col("event_type") == "click", "note").otherwise("answer").alias("type"),
    )


@query(f"""
SELECT CAST(user_id AS VARCHAR) AS record, 'mrn' AS field_name, CAST(user_id AS VARCHAR) AS value,
       CAST(NULL AS VARCHAR) AS redcap_event_name FROM events WHERE event_type NOT IN ('error', 'click')
UNION ALL SELECT CAST(user_id AS VARCHAR), 'alerts_parent_' || event_type || '_' || event_id, {MONEY.format('value')}, NULL
FROM events WHERE event_type NOT IN ('error', 'click')
""")
def parse_alert(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.parsed_alerts(_messages(spark, sf))


@query("SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE event_type = 'error'")
def rejected_alert(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.rejected_alerts(_messages(spark, sf)).select("id")


# ---------------------------------------------------------------- arrays and JSON


@query(r"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, md5(items[i]) AS item, md5(answers[i]) AS answer
FROM (SELECT *, unnest(range(1, len(items) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS items, string_split(text, '. ') AS answers FROM documents))
""")
def zip_items(spark: SparkSession, sf: str) -> DataFrame:
    pairs = nested.pair_items(F.split("text", "\n"), F.split("text", "\\. "))
    rows = table(spark, sf, "documents").select("doc_id", F.inline(pairs))
    return rows.select("doc_id", "position", F.md5("item").alias("item"), F.md5("answer").alias("answer"))


@query("""
SELECT p_partkey, u.name, u.value, u.score FROM part, unnest([
  {'name': p_name, 'value': p_size, 'score': 0}, {'name': '', 'value': 0, 'score': p_size}]) AS t(u)
""")
def option_norm(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None)
    options = F.array(
        F.struct(F.col("p_name").alias("text"), F.col("p_size").alias("value"), none.cast("int").alias("score")),
        F.struct(none.cast("string").alias("text"), none.cast("int").alias("value"), F.col("p_size").alias("score")),
    )
    return table(spark, sf, "part").select("p_partkey", F.inline(nested.normalize_options(options)))


@query("""
SELECT event_id, 'kind' AS type, CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'click' THEN 'click'
         WHEN 'purchase' THEN '["a","' || user_id || '"]' END AS raw_value,
       event_type IN ('error', 'signup') AS null_value, CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS single_value,
       CASE WHEN event_type = 'purchase' THEN 'a,' || user_id END AS value,
       CASE WHEN event_type = 'click' THEN 'click' END AS text, CAST(NULL AS VARCHAR) AS geo
FROM events
""")
def response_union(spark: SparkSession, sf: str) -> DataFrame:
    kind, user = F.col("event_type"), text("user_id")
    raw = (
        F.when(kind == "view", user)
        .when(kind == "click", F.concat(F.lit('"'), kind, F.lit('"')))
        .when(kind == "purchase", F.concat(F.lit('["a","'), user, F.lit('"]')))
        .when(kind == "error", "null")
    )
    union = table(spark, sf, "events").select("event_id", nested.response_value(F.lit("kind"), raw).alias("r"))
    return union.select(
        "event_id", "r.type", "r.raw_value", "r.null_value", text("r.single_value").alias("single_value"),
        F.array_join("r.value", ",").alias("value"), "r.text", "r.geo",
    )


@query("""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id AS VARCHAR) END AS first_entry,
       CASE event_type WHEN 'view' THEN 'last' WHEN 'click' THEN CAST(event_id AS VARCHAR) END AS last_entry FROM events
""")
def array_entry(spark: SparkSession, sf: str) -> DataFrame:
    entries = F.array(
        F.struct(F.lit("other").alias("kind"), F.lit("none").alias("id")),
        F.struct(F.nullif(F.col("event_type"), F.lit("click")).alias("kind"), text("event_id").alias("id")),
        F.struct(F.lit("click").alias("kind"), text("event_id").alias("id")),
        F.struct(F.lit("view").alias("kind"), F.lit("last").alias("id")),
    )
    wanted = F.when(F.col("event_type").isin("view", "click"), F.col("event_type"))
    return table(spark, sf, "events").select(
        "event_id",
        nested.entry_by_id(entries, "kind", wanted)["id"].alias("first_entry"),
        nested.entry_by_id(entries, "kind", wanted, last=True)["id"].alias("last_entry"),
    )


@query("""
SELECT c_custkey, 'shell-account' AS route, '{"c_name":"' || c_name || '"'
  || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END
  || ',"tags":' || CASE WHEN c_nationkey < 10 THEN '"a"' ELSE '["b","a"]' END
  || ',"parent_involvement":' || CASE WHEN c_nationkey < 10 THEN '["1"]' ELSE '["1","2"]' END
  || ',"accountType":"limited"}' AS body
FROM customer
""")
def outbound_json(spark: SparkSession, sf: str) -> DataFrame:
    near = F.col("c_nationkey") < 10
    wide = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.when(near, F.array(F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("a"))).alias("tags"),
        F.when(near, F.array(F.lit("1"))).otherwise(F.array(F.lit("2"), F.lit("1"))).alias("parent_involvement"),
        F.lit("limited").alias("accountType"),
    )
    body = nested.outbound_body(wide.drop("c_custkey"))
    return wide.select("c_custkey", nested.account_route(F.col("accountType")).alias("route"), body.alias("body"))


@query("""
SELECT c_custkey FROM customer WHERE c_nationkey < 10 OR c_mktsegment = 'BUILDING'
""")
def in_set(spark: SparkSession, sf: str) -> DataFrame:
    values = F.when(F.col("c_mktsegment") != "BUILDING",
                    F.when(F.col("c_nationkey") < 10, F.array(F.lit("3"), F.lit("1"))).otherwise(F.array(F.lit("3"))))
    return table(spark, sf, "customer").where(nested.in_set_or_null(values)).select("c_custkey")


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """One activity answer per event: its type and user as two items, answers for the first only."""
    kind, user = F.col("event_type"), text("user_id")
    options = F.array(F.struct(kind.alias("text"), F.lit(1).alias("value"), F.lit(None).cast("int").alias("score")))

    def item(name, shape):
        return F.struct(
            user.alias("id"), name.alias("name"), F.struct(kind.alias("en")).alias("question"),
            F.lit(shape).alias("responseType"), F.struct(options.alias("options")).alias("responseValues"),
        )

    return table(spark, sf, "events").select(
        F.lit("record").alias("record_id"), user.alias("respondent_id"), text("event_id").alias("submitId"),
        F.lit("1.0.0").alias("version"), iso("ts").alias("startDatetime"), F.concat(iso("ts"), F.lit("Z")).alias("endDatetime"),
        user.alias("respondentSecretId"), F.lit(None).cast("string").alias("sourceSecretId"),
        F.array(item(kind, "singleSelect"), item(F.lit("other"), "text")).alias("items"),
        F.array(F.struct(F.concat(F.lit('"'), kind, F.lit('"')).alias("value"))).alias("answer"),
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS submission, 0 AS position, event_type AS item, 'singleSelect' AS kind, event_type AS option,
       event_type AS answer, false AS missing, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS started,
       CAST(user_id AS VARCHAR) AS target, '' AS source, 'Account Created' AS label FROM events
UNION ALL
SELECT CAST(event_id AS VARCHAR), 1, 'other', 'text', event_type, NULL, true,
       strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g'), CAST(user_id AS VARCHAR), '', 'Account Created' FROM events
""")
def answer_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = invitations.answer_rows(answers(spark, sf), "account_created")
    return rows.select(
        F.col("activity_submission.id").alias("submission"), "position", F.col("item.name").alias("item"),
        F.col("response.value.type").alias("kind"), F.col("item.response_options")[0]["name"].alias("option"),
        F.col("response.value.text").alias("answer"), F.col("response.value.null_value").alias("missing"),
        F.date_format("activity_time.end_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("started"),
        F.col("target_user.secret_id").alias("target"), F.col("source_user.secret_id").alias("source"),
        F.col("activity.name").alias("label"),
    )
