"""Code lists, choice strings and value rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.dates import age_years
from recordflow.functions.text import strip_zeros
from recordflow.operators.dedup import first_of, last_of
from recordflow.operators.joins import only_keys, same_key
from recordflow.operators.select import CodeList, Range
from recordflow.schemas import EVENT, FIELD, RECORD, VALUE

CHOICES = "select_choices_or_calculations"
OPTIONS_SCHEMA = "array<struct<name:string,value:string,score:string>>"


# ---------------------------------------------------------------- choice strings


def choice_rows(dictionary: DataFrame) -> DataFrame:
    """``field_name, label, code, position`` of ``code, label | code, label`` texts.

    Labels are lower-cased, integer codes normalized, parts without ``", "`` skipped.
    """
    parts = dictionary.select(FIELD, F.posexplode(F.split(CHOICES, r"\|")).alias("position", "part"))
    pair = F.split("part", ", ", 2)
    return parts.where(F.size(pair) == 2).select(
        FIELD,
        F.lower(F.trim(pair[1])).alias("label"),
        strip_zeros(F.trim(pair[0])).alias("code"),
        "position",
    )


def radio_choices(dictionary: DataFrame) -> DataFrame:
    """As `choice_rows`, for radio fields: cut at the first comma, case kept, last label wins."""
    radio = dictionary.where(F.col("field_type") == "radio")
    parts = radio.select(FIELD, F.posexplode(F.split(CHOICES, r"\|")).alias("position", "part"))
    comma = F.instr("part", ",")
    rows = parts.where(comma > 0).select(
        FIELD,
        F.trim(F.substring("part", comma + 1, F.length("part"))).alias("label"),
        F.trim(F.substring("part", F.lit(1), comma - 1)).alias("code"),
        "position",
    )
    return rows.groupBy(FIELD, "label").agg(F.max_by("code", "position").alias("code"))


def label_to_code(eav: DataFrame, choices: DataFrame) -> DataFrame:
    """Replace labels by codes, matched on field and trimmed lower-case value; others stay."""
    codes = choices.groupBy(F.col(FIELD).alias("_field"), F.col("label").alias("_label")).agg(
        F.max_by("code", "position").alias("_code")
    )
    on = same_key(F.col(FIELD), codes["_field"]) & same_key(F.lower(F.trim(VALUE)), codes["_label"])
    joined = eav.join(codes, on, "left")
    return joined.withColumn(VALUE, F.coalesce("_code", VALUE)).drop("_field", "_label", "_code")


def remap_responses(
    responses: DataFrame, dictionary: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Replace app values or scores by the dictionary's codes, matched on the option label.

    `responses` has ``field_name, value, options`` (a JSON list of ``name, value, score``);
    the options of a field are those of its first row that has any. Per field the values
    decide whether they are option values or scores: values if all are (or, failing both, if
    any is), else scores.
    """
    choices = radio_choices(dictionary)
    coded = only_keys(responses, F.col(FIELD), choices.select(FIELD))
    first_options = (
        coded.where(F.col("options").isNotNull())
        .groupBy(FIELD)
        .agg(first_of("options", order_by).alias("options"))
    )
    options = first_options.select(
        FIELD, F.posexplode(F.from_json("options", OPTIONS_SCHEMA)).alias("position", "o")
    ).select(FIELD, "position", F.trim("o.name").alias("label"), "o.value", "o.score")

    raw = coded.select(FIELD, VALUE).dropna().distinct()
    values = options.select(FIELD, VALUE).distinct().withColumn("_is_value", F.lit(True))
    scores = options.select(FIELD, F.col("score").alias(VALUE)).dropna().distinct()
    scores = scores.withColumn("_is_score", F.lit(True))
    is_value = F.coalesce("_is_value", F.lit(False))
    is_score = F.coalesce("_is_score", F.lit(False))
    source = (
        raw.join(values, [FIELD, VALUE], "left")
        .join(scores, [FIELD, VALUE], "left")
        .groupBy(FIELD)
        .agg(
            F.bool_and(is_value).alias("all_values"),
            F.bool_and(is_score).alias("all_scores"),
            F.bool_or(is_value).alias("any_value"),
        )
        .select(
            FIELD,
            F.when(F.col("all_values"), "value")
            .when(F.col("all_scores"), "score")
            .when(F.col("any_value"), "value")
            .otherwise("score")
            .alias("source"),
        )
    )
    held = F.when(F.col("source") == "value", F.col(VALUE)).otherwise(F.coalesce("score", F.lit("")))
    mapping = (
        options.join(source, FIELD)
        .select(FIELD, "label", "position", held.alias("_from"))
        .join(choices, [FIELD, "label"])
        .where((F.col("code") != "") & (F.col("_from") != ""))
        .groupBy(F.col(FIELD).alias("_field"), "_from")
        .agg(F.max_by("code", "position").alias("_code"))
    )
    on = same_key(responses[FIELD], mapping["_field"]) & same_key(responses[VALUE], mapping["_from"])
    joined = responses.join(mapping, on, "left")
    return joined.withColumn(VALUE, F.coalesce("_code", VALUE)).drop("_field", "_from", "_code")


# ---------------------------------------------------------------- rules per record


@dataclass(frozen=True)
class RecordRule:
    """Overwrite or append `target` where `result` of the record's `source` value is not null."""

    target: str
    source: str
    result: Callable[[Column], Column]


def record_facts(
    eav: DataFrame,
    rules: Sequence[RecordRule],
    order_by: Sequence[str] | None = None,
    id_field: str | None = None,
    flag: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per record with what the rules (and the ID, and the flag) need of it.

    A single aggregate with a map-side part: a record with very many rows is reduced before
    the shuffle. Only rows of `fact_fields` matter, so a caller may filter to those first.
    With a flag (field, code), records without it are left out.
    """

    def last(field: str) -> Column:
        return last_of(VALUE, order_by, F.col(FIELD) == field)

    wanted = eav.where(F.col(FIELD).isin(*fact_fields(rules, id_field, flag)))
    columns = [last(rule.source).alias(f"_source{i}") for i, rule in enumerate(rules)]
    columns += [F.bool_or(F.col(FIELD) == r.target).alias(f"_held{i}") for i, r in enumerate(rules)]
    if id_field:
        columns.append(last(id_field).alias("_id"))
    if flag:
        columns.append(F.bool_or((F.col(FIELD) == flag[0]) & (F.col(VALUE) == flag[1])).alias("_flag"))
    facts = wanted.groupBy(F.col(RECORD).alias("_record")).agg(*columns)
    if flag:
        facts = facts.where("_flag")
    news = [rule.result(F.col(f"_source{i}")).alias(f"_new{i}") for i, rule in enumerate(rules)]
    held = [f"_held{i}" for i in range(len(rules))]
    facts = facts.select("_record", *news, *held, *(["_id"] if id_field else []))
    if flag:
        return facts
    useful = [f"_new{i}" for i in range(len(rules))] + (["_id"] if id_field else [])
    return facts.where(F.coalesce(*useful).isNotNull())


def fact_fields(
    rules: Sequence[RecordRule], id_field: str | None = None, flag: tuple[str, str] | None = None
) -> list[str]:
    """Fields that `record_facts` reads."""
    fields = {name for rule in rules for name in (rule.target, rule.source)}
    fields |= {id_field} if id_field else set()
    fields |= {flag[0]} if flag else set()
    return sorted(fields)


def apply_facts(
    eav: DataFrame, facts: DataFrame, rules: Sequence[RecordRule], how: str = "left"
) -> DataFrame:
    """Apply rules, and move rows to the record's ID if the facts hold one, in one join.

    Existing target rows are overwritten; a record without the target gets a row whose other
    columns are null. With ``how="inner"`` only the records of the facts remain.
    """
    record, value = F.col(RECORD), F.col(VALUE)
    moved = "_id" in facts.columns
    for i, rule in enumerate(rules):
        hit = (F.col(FIELD) == rule.target) & F.col(f"_new{i}").isNotNull()
        value = F.when(hit, F.col(f"_new{i}")).otherwise(value)
    if moved:
        record = F.coalesce("_id", record)
        value = F.when(F.col(FIELD) == "record_id", record).otherwise(value)
    updated = (
        eav.join(facts, same_key(eav[RECORD], facts["_record"]), how)
        .withColumns({RECORD: record, VALUE: value})
        .select(*eav.columns)
    )
    missing = [
        F.when(
            F.col(f"_new{i}").isNotNull() & ~F.col(f"_held{i}"),
            F.struct(F.lit(rule.target).alias(FIELD), F.col(f"_new{i}").alias(VALUE)),
        )
        for i, rule in enumerate(rules)
    ]
    owner = F.coalesce("_id", "_record") if moved else F.col("_record")
    appended = facts.select(
        owner.alias(RECORD), F.explode(F.array_compact(F.array(*missing))).alias("m")
    )
    return updated.unionByName(appended.select(RECORD, "m.*"), allowMissingColumns=True)


def apply_rules(
    eav: DataFrame, rules: Sequence[RecordRule], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Apply rules that set one field of a record from another field of it."""
    return apply_facts(eav, record_facts(eav, rules, order_by), rules)


def mapped_rule(target: str, source: str, codes: Mapping[str, str]) -> RecordRule:
    """Rule that maps source codes to target codes; codes not listed change nothing."""
    return RecordRule(target, source, CodeList(source, codes).encode)


def age_rule(
    target: str, age_range: Range, code: str, as_of: date | str, source: str = "dob"
) -> RecordRule:
    """Rule that sets `code` where the age lies outside the range; no date changes nothing."""
    return RecordRule(
        target,
        source,
        lambda dob: F.when(~age_range.contains(age_years(dob, as_of)), F.lit(code)),
    )


# ---------------------------------------------------------------- recodes


def decrement_code(eav: DataFrame, field: str) -> DataFrame:
    """Lower the numeric value of a field by one; a value that is no number becomes null."""
    number = F.col(VALUE).try_cast("double")
    lowered = F.when(number == F.floor(number), (number - 1).try_cast("bigint").cast("string")).otherwise(
        (number - 1).cast("string")
    )
    return eav.withColumn(VALUE, F.when(F.col(FIELD) == field, lowered).otherwise(F.col(VALUE)))


def complete_to_received(
    eav: DataFrame,
    suffix: str = "complete",
    complete: int = 2,
    value: str = "1",
    event: str = "admin_arm_1",
) -> DataFrame:
    """Rows of ``…_<suffix>`` fields that are complete, with a fixed value and event."""
    done = F.col(FIELD).endswith(f"_{suffix}") & (F.col(VALUE).try_cast("double") == complete)
    return eav.where(done).select(
        RECORD, FIELD, F.lit(value).alias(VALUE), F.lit(event).alias(EVENT)
    )


def default_no(
    df: DataFrame,
    positives: DataFrame,
    instrument: str,
    event: str,
    id_column: str = "record_id",
    event_column: str | None = EVENT,
) -> DataFrame:
    """Add a ``<instrument>_alerts = no`` row per record that is not among `positives`.

    `positives` has one column of record IDs whose flag is already ``yes``.
    """
    flag = f"{instrument.lower()}_alerts"
    if flag in df.columns:
        return df
    yes = positives.toDF("_yes").select(F.col("_yes").cast("string")).distinct()
    ids = df.select(id_column).distinct()
    rows = ids.join(yes, ids[id_column].cast("string") == yes["_yes"], "left_anti").select(
        id_column, F.lit("no").alias(flag), F.lit(event).alias(event_column or EVENT)
    )
    return df.unionByName(rows, allowMissingColumns=True)


def completion_status(
    response: Column | None,
    invite_status: Column,
    confirmed: str = "1",
    invited: str = "3",
    unverified: str = "1",
    incomplete: str = "0",
) -> Column:
    """Form status: from the response column if there is one, else from the invite status."""
    if response is not None:
        good = response.cast("string") == confirmed
    else:
        good = invite_status.cast("string") == invited
    return F.when(good, unverified).otherwise(incomplete)


# Instruments answered by a parent although their name does not end in `_p`.
PARENT_INSTRUMENTS = ("ace_p", "parent_baseline", "parent_followup")


def alert_form(
    instrument: Column, parent: str = "ra_alerts_parent", child: str = "ra_alerts_child"
) -> Column:
    """Alert form (parent or child) of an instrument name."""
    is_parent = instrument.endswith("_p") | instrument.isin(*PARENT_INSTRUMENTS)
    return F.when(is_parent, parent).otherwise(child)


def alert_form_of_field(
    field: Column, parent: str = "ra_alerts_parent", child: str = "ra_alerts_child"
) -> Column:
    """Alert form of an ``alerts_…_<n>`` or ``…_alerts`` field name; parent if it has neither shape."""
    by_item = F.regexp_extract(field, r"alerts_([a-z_]+)_\d+", 1)
    by_flag = F.regexp_extract(field, r"^([a-z_]+)_alerts$", 1)
    part = F.coalesce(F.nullif(by_item, F.lit("")), F.nullif(by_flag, F.lit("")))
    return (
        F.when(part.isNull(), parent)
        .when(part.contains("parent") | part.endswith("_p"), parent)
        .when(part.contains("child") | part.endswith("_c"), child)
        .when(part.startswith("ra_alerts"), part)
        .otherwise(alert_form(part, parent, child))
    )
