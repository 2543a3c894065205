"""Stream envelopes: base64 text around a UTF-8 JSON object.

The expressions are stateless, so they serve batch frames and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.columns import holds

OUTCOME = "outcome"
VALID = "valid"

# Fields a record must carry (their value may be null).
REQUIRED_CRM = ("customer_id", "interaction_type", "timestamp")
REQUIRED_WTL = ("session_id", "page", "timestamp")


def carries(text: Column, required: Sequence[str]) -> Column:
    """True where the text is a JSON object with all the fields, null where it is no object."""
    absent = F.array_except(F.array(*[F.lit(name) for name in required]), F.json_object_keys(text))
    return absent == F.array().cast("array<string>")


def encode(text: Column) -> Column:
    """The envelope of a JSON text."""
    return F.base64(F.encode(text, "utf-8"))


def decode_envelopes(
    df: DataFrame, schema: T.StructType, required: Sequence[str], column: str = "data"
) -> DataFrame:
    """Replace the envelope by the fields of its record and say what became of it.

    Outcomes: ``valid``, ``empty``, ``bad_base64``, ``bad_utf8``, ``bad_json`` and
    ``missing_field``. Only valid records have fields; nothing is dropped. The result
    comes out of a one-element ``inline``, which later filters on the outcome do not
    pass, so that each envelope is opened and parsed once.
    """
    raw, binary, text = F.col(column), F.col("_binary"), F.col("_text")
    complete, records = F.col("_complete"), F.col("_records")
    # Each step is a column of its own, since every one is needed more than once. The
    # record is parsed as the only element of an array, which fails on text after it.
    opened = (
        df.withColumn("_binary", F.try_to_binary(raw, F.lit("base64")))
        .withColumn("_text", F.try_validate_utf8(binary.cast("string")))
        .withColumn("_complete", carries(text, required))
        .withColumn(
            "_records",
            F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema)),
        )
    )
    outcome = (
        F.when(raw.isNull() | (raw == ""), "empty")
        .when(binary.isNull(), "bad_base64")
        .when(text.isNull(), "bad_utf8")
        .when(complete.isNull() | ~holds(F.size(records) == 1), "bad_json")
        .when(~complete, "missing_field")
        .otherwise(VALID)
    )
    judged = opened.withColumn(OUTCOME, outcome).withColumn(
        "_record", F.when(F.col(OUTCOME) == VALID, F.get(records, 0))
    )
    fields = [F.col(f"_record.{name}").alias(name) for name in schema.names]
    others = [c for c in df.columns if c != column]
    return judged.select(*others, F.inline_outer(F.array(F.struct(OUTCOME, *fields))))


def valid_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(OUTCOME) == VALID).drop(OUTCOME)


def refused_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(OUTCOME) != VALID)
