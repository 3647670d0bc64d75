"""Arrays, structs and JSON values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def pair_items(items: Column, answers: Column) -> Column:
    """Array of ``(position, item, answer)``; a missing answer is null, a surplus one dropped."""
    pairs = F.zip_with(
        items,
        F.coalesce(answers, F.array()),
        lambda item, answer: F.struct(item.alias("item"), answer.alias("answer")),
    )
    numbered = F.transform(
        pairs,
        lambda pair, i: F.struct(
            i.alias("position"), pair["item"].alias("item"), pair["answer"].alias("answer")
        ),
    )
    return F.slice(numbered, F.lit(1), F.size(items))


def normalize_options(options: Column) -> Column:
    """Array of ``(name, value, score)`` with missing parts filled."""
    return F.transform(
        options,
        lambda o: F.struct(
            F.coalesce(o["text"], F.lit("")).alias("name"),
            F.coalesce(o["value"], F.lit(0)).alias("value"),
            F.coalesce(o["score"], F.lit(0)).alias("score"),
        ),
    )


def response_value(kind: Column, json_text: Column) -> Column:
    """Tagged union of a JSON value: exactly the member that fits its type is filled."""
    variant = F.try_parse_json(json_text)
    shape = F.schema_of_variant(variant)
    missing = json_text.isNull() | variant.isNull() | F.is_variant_null(variant)
    is_list = shape.startswith("ARRAY")
    is_text = shape == "STRING"
    is_int = shape == "BIGINT"
    return F.struct(
        kind.alias("type"),
        F.when(~missing, variant.cast("string")).alias("raw_value"),
        missing.alias("null_value"),
        F.when(~missing & is_int, F.try_variant_get(variant, "$", "bigint")).alias("single_value"),
        F.when(~missing & is_list, F.try_variant_get(variant, "$", "array<string>")).alias("value"),
        F.when(~missing & is_text, F.try_variant_get(variant, "$", "string")).alias("text"),
        *[
            F.lit(None).cast("string").alias(name)
            for name in (
                "file",
                "date",
                "time",
                "time_range",
                "geo",
                "matrix",
                "optional_text",
                "subscale",
            )
        ],
    )


def entry_by_id(entries: Column, id_field: str, wanted: Column, last: bool = False) -> Column:
    """First (or last) array entry with the wanted ID, null if there is none."""
    return F.try_element_at(
        F.filter(entries, lambda e: e[id_field] == wanted), F.lit(-1 if last else 1)
    )


def in_set_or_null(values: Column, wanted: str = "1") -> Column:
    """True where the array holds the value, or is missing."""
    return values.isNull() | F.array_contains(values, wanted)


def _json_member(name: str, value: Column) -> Column:
    """``"name":value`` or null where the value is null."""
    text = F.to_json(F.struct(value.alias(name)))
    return F.nullif(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(""))


def outbound_body(df: DataFrame, set_columns: tuple[str, ...] = ("parent_involvement",)) -> Column:
    """JSON body of a row: nulls left out, one-element arrays unwrapped.

    Columns named in `set_columns` stay arrays and are sorted.
    """
    members = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.ArrayType):
            members.append(_json_member(field.name, column))
        elif field.name in set_columns:
            members.append(_json_member(field.name, F.sort_array(column)))
        else:
            members.append(
                F.when(F.size(column) == 1, _json_member(field.name, F.try_element_at(column, F.lit(1))))
                .otherwise(_json_member(field.name, column))
            )
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def account_route(
    account_type: Column, routes: Mapping[str, str] = {"limited": "shell-account", "full": "respondent"}
) -> Column:
    """Route of an account type; null marks a row that must be rejected."""
    route = F.lit(None).cast("string")
    for kind, target in routes.items():
        route = F.when(account_type == kind, target).otherwise(route)
    return route


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def _renamed(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(_camel(f.name), _renamed(f.dataType), True) for f in kind.fields]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType), True)
    return kind


def both_spellings(schema: T.StructType) -> T.StructType:
    """A schema that also takes the camelCase spelling of every snake_case column."""
    second = [T.StructField(_camel(f.name), _renamed(f.dataType)) for f in schema.fields if _camel(f.name) != f.name]
    return T.StructType([*schema.fields, *second])


def either_spelling(df: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """Columns of `schema` under their camelCase names, from whichever spelling holds a value."""

    def cell(field: T.StructField) -> Column:
        name = _camel(field.name)
        value = F.col(f"`{field.name}`").cast(_renamed(field.dataType))
        return (value if name == field.name else F.coalesce(value, F.col(f"`{name}`"))).alias(name)

    return df.select([cell(f) for f in schema.fields] + list(others))


def camel_case(df: DataFrame) -> DataFrame:
    """Rename snake_case columns and nested fields to camelCase."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast(_renamed(f.dataType)).alias(_camel(f.name))
            for f in df.schema.fields
        ]
    )
