"""JSON messages to typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.once import fields_once

#: Column of a decoded message that says why it is none; null for messages that are.
REJECTED = "rejected"
#: Field that takes the text of a message the parser stumbles over.
CORRUPT = "__corrupt"


def decode_json(
    messages: DataFrame, schema: StructType, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """Text or binary payload [PRJ1] parsed against a schema [PRJ2] and flattened [PRJ3].

    Nothing is rejected: a payload that is no JSON object gives a row of nulls.

    Each message is parsed once, whatever columns are tested afterwards and
    whatever the session's JSON optimizer settings are.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(*keep, fields_once(parsed))


def decode_or_reject(
    messages: DataFrame, schema: StructType, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """As :func:`decode_json`, with a column ``rejected`` (text, kind) that is null for messages of the schema [PRJ2].

    Kinds are ``absent`` (a null payload), ``empty`` (nothing but white space),
    ``malformed`` (no JSON object) and ``mistyped`` (an object in which a field
    holds another type; its other fields are kept). An object without some of
    the fields is a message. What follows a complete object is ignored, as the
    parser does. Only rejected texts are looked at a second time.
    """
    keep = list(keep)
    taken = [name for name in (*schema.names, *keep) if name.lower() in (REJECTED, CORRUPT)]
    if taken:
        raise ValueError(f"fields and kept columns may not be named {', '.join(taken)}")
    with_text = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(F.col(value).cast("string"), with_text, {"columnNameOfCorruptRecord": CORRUPT})
    rows = messages.select(*keep, F.col(value).cast("string").alias(REJECTED), fields_once(parsed))
    text = F.col(REJECTED)
    kind = (
        F.when(text.isNull(), "absent")
        .when(F.trim(text, F.lit(" \t\r\n")) == "", "empty")
        .when(F.col(CORRUPT).isNotNull() & F.from_json(text, "map<string,string>").isNull(), "malformed")
        .when(F.col(CORRUPT).isNotNull(), "mistyped")
    )
    reason = F.struct(text.alias("text"), kind.alias("kind"))
    return rows.select(*keep, *schema.names, F.when(kind.isNotNull(), reason).alias(REJECTED))


def accepted(decoded: DataFrame) -> DataFrame:
    """Messages of the schema."""
    return decoded.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejects(decoded: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Text and kind of the other messages."""
    return decoded.where(F.col(REJECTED).isNotNull()).select(*keep, f"{REJECTED}.*")
