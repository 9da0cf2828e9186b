"""Reading the fields of JSON messages (VARIANT) under the accept rules of the contracts.

``take`` opens a message into one group of columns per field; the readers turn a group into the
typed value (NULL if refused) and into the name of the broken rule (NULL if accepted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import epoch_time, event_time_utc

# Names of the broken rules.
MISSING = "missing"
NOT_JSON = "json_invalid"
STRING_TYPE = "string_type"
INT_TYPE = "int_type"
INT_PARSING = "int_parsing"
INT_FROM_FLOAT = "int_from_float"
FLOAT_TYPE = "float_type"
FLOAT_PARSING = "float_parsing"
LITERAL = "literal_error"
TIME_TYPE = "datetime_type"
TIME_PARSING = "datetime_parsing"
DICT_TYPE = "model_type"
NEGATIVE = "greater_than_equal"
VALUE = "value_error"

INT_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0+)?\s*\z"
FLOAT_TEXT = r"^\s*[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def parse_whole(df: DataFrame, into: str, text: Column) -> DataFrame:
    """Add the one JSON document a text consists of as a VARIANT; NULL if it is anything else.

    The JSON readers stop after the first document and would not see what follows it. So the text
    is read as the first element of an array whose second one shows that the end was reached.
    """
    mark = F.xxhash64(text)
    marked = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
    read = settle(df, _read=F.try_parse_json(marked), _mark=mark)
    ended = F.try_variant_get("_read", "$[1]", "bigint") == F.col("_mark")
    whole = F.when(ended, F.try_variant_get("_read", "$[0]", "variant"))
    return read.withColumn(into, whole).drop("_read", "_mark")


def read_whole(df: DataFrame, into: str, text: Column, fields: str) -> DataFrame:
    """Add the one JSON object a text consists of, its fields read as texts; NULL if it is not one.

    Cheaper than ``parse_whole``, but the kind of a field is lost.
    """
    mark = F.xxhash64(text)
    marked = F.concat(F.lit("["), text, F.lit(',{"_end":'), mark.cast("string"), F.lit("}]"))
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    array = F.from_json(marked, f"array<struct<{fields}, _end bigint>>", strict)
    read = settle(df, _read=array, _mark=mark)
    ended = F.get("_read", F.lit(1))["_end"] == F.col("_mark")
    return read.withColumn(into, F.when(ended, F.get("_read", F.lit(0)))).drop("_read", "_mark")


def take(df: DataFrame, document: str, fields: Sequence[str]) -> DataFrame:
    """Add per field of a VARIANT column: ``_<field>``, its JSON kind and its text if it is a STRING.

    Kinds are STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID, OBJECT, ARRAY; NULL if missing.
    """
    opened = df.withColumns(
        {f"_{name}": F.try_variant_get(F.col(document), f"$.{name}", "variant") for name in fields}
    )
    kinds = {
        f"_{name}_kind": F.regexp_extract(F.schema_of_variant(F.col(f"_{name}")), "^[A-Z]+", 0)
        for name in fields
    }
    texts = {f"_{name}_text": F.when(_kind(name) == "STRING", _as(name, "string")) for name in fields}
    return opened.withColumns(kinds).withColumns(texts)


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter over an ordinary projection is rewritten in terms of the projection's input, which
    would repeat a long chain of parsing for every condition. A generator is not looked through.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _kind(name: str) -> Column:
    return F.col(f"_{name}_kind")


def _text(name: str) -> Column:
    return F.col(f"_{name}_text")


def _as(name: str, kind: str) -> Column:
    return F.try_variant_get(F.col(f"_{name}"), "$", kind)


def _real(name: str) -> Column:
    return _kind(name).isin("DECIMAL", "DOUBLE", "FLOAT")


def _number(name: str) -> Column:
    return (_kind(name) == "BIGINT") | _real(name)


def text_value(name: str) -> Column:
    """Text only: numbers are refused, the empty text is accepted."""
    return _text(name)


def text_error(name: str) -> Column:
    return F.when(F.col(f"_{name}").isNull(), MISSING).when(_kind(name) != "STRING", STRING_TYPE)


def choice_value(name: str, choices: Sequence[str]) -> Column:
    """One of the given texts."""
    return F.when(_text(name).isin(*choices), _text(name))


def choice_error(name: str, value: Column) -> Column:
    return F.when(F.col(f"_{name}").isNull(), MISSING).when(value.isNull(), LITERAL)


def int_value(name: str) -> Column:
    """Integer, integral real, boolean, or text of one of the first two."""
    number = _as(name, "double")
    written = F.regexp_replace(_text(name), r"[\s_]|\.0+\s*\z", "").try_cast("bigint")
    return (
        F.when(_kind(name).isin("BIGINT", "BOOLEAN"), _as(name, "bigint"))
        .when(_real(name), F.when(number == F.floor(number), _as(name, "bigint")))
        .when(_text(name).rlike(INT_TEXT), written)
    )


def int_error(name: str, value: Column) -> Column:
    return F.when(F.col(f"_{name}").isNull(), MISSING).when(
        value.isNull(),
        F.when(_kind(name) == "STRING", INT_PARSING).when(_real(name), INT_FROM_FLOAT).otherwise(INT_TYPE),
    )


def float_value(name: str) -> Column:
    """Number, boolean, or text of a finite number."""
    written = F.regexp_replace(_text(name), r"[\s_]", "").try_cast("double")
    return F.when(_number(name) | (_kind(name) == "BOOLEAN"), _as(name, "double")).when(
        _text(name).rlike(FLOAT_TEXT), written
    )


def float_error(name: str, value: Column) -> Column:
    return F.when(F.col(f"_{name}").isNull(), MISSING).when(
        value.isNull(), F.when(_kind(name) == "STRING", FLOAT_PARSING).otherwise(FLOAT_TYPE)
    )


def time_value(name: str) -> Column:
    """ISO-8601 text, or an epoch number as number or text; UTC, whole seconds."""
    return F.when(_kind(name) == "STRING", event_time_utc(_text(name))).when(
        _number(name), epoch_time(_as(name, "double"))
    )


def time_error(name: str, value: Column) -> Column:
    return F.when(F.col(f"_{name}").isNull(), MISSING).when(
        value.isNull(), F.when(_number(name) | (_kind(name) == "STRING"), TIME_PARSING).otherwise(TIME_TYPE)
    )


def broken(is_json: Column, good: Column, rules: dict[str, Column]) -> Column:
    """Array of ``(field, error)`` for the broken rules, in the order given.

    ``good`` must hold exactly if no rule is broken; the rules are then not looked at.
    """
    nothing = F.array().cast("array<struct<field:string,error:string>>")

    def one(name: str, error: Column) -> Column:
        return F.array(F.struct(F.lit(name).alias("field"), error.alias("error")))

    found = [F.when(error.isNotNull(), one(name, error)).otherwise(nothing) for name, error in rules.items()]
    return F.when(good, nothing).when(is_json, F.concat(*found)).otherwise(one("$", F.lit(NOT_JSON)))
