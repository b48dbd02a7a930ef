"""JSON messages to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ON_MALFORMED = ("keep", "drop", "quarantine")


def decode(
    messages: DataFrame,
    schema: T.StructType,
    *,
    on_malformed: str = "keep",
    envelope: Sequence[str | Column] = (),
) -> DataFrame:
    """Parse the JSON in ``value`` (bytes or text) into the columns of ``schema``.

    A field that does not fit its type is NULL and leaves the others alone. A
    message that yields no field at all counts as malformed: ``keep`` passes it on
    as a row of NULLs, ``drop`` removes it, ``quarantine`` adds a column
    ``malformed`` with its text (NULL on good rows) for the sink to route by.
    ``envelope`` names message columns to carry along.

    The parsed struct is laid out by a generator on purpose. With ``json.*`` the
    optimizer moves later filters below the projection and parses each message
    once more for every field the filter reads.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}, not {on_malformed!r}")

    text = F.col("value").cast("string")
    kept = [text.alias("malformed")] if on_malformed == "quarantine" else []
    rows = messages.select(*envelope, *kept, F.inline(F.array(F.from_json(text, schema))))
    if on_malformed == "keep":
        return rows

    readable = F.coalesce(*[F.col(f).cast("string") for f in schema.fieldNames()]).isNotNull()
    if on_malformed == "drop":
        return rows.where(readable)
    # An empty or missing text still has to show up as malformed.
    return rows.withColumn(
        "malformed", F.when(~readable, F.coalesce(F.col("malformed"), F.lit("")))
    )


def _kind(variant: Column) -> Column:
    """What a JSON value is; NULL where there is none or it is null itself."""
    found = F.schema_of_variant(variant)
    return (
        F.when(found.isNull() | (found == "VOID"), F.lit(None).cast("string"))
        .when(found == "STRING", "text")
        .when(found == "BOOLEAN", "boolean")
        .when(found.startswith("OBJECT"), "object")
        .when(found.startswith("ARRAY"), "list")
        .when((found == "BIGINT") | found.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .otherwise("fraction")
    )


def field_faults(
    messages: DataFrame, schema: T.StructType, *, envelope: Sequence[str] = ()
) -> DataFrame:
    """The fields that ``decode`` makes NULL though the message has a value for them.

    One row per such field: the ``envelope``, ``field``, ``kind`` (text, integer, fraction,
    boolean, object, list) and ``found``, the value as text. A field that is absent or null
    is no fault, nor are the fields of a message that is no JSON object or names a field
    twice: that message is at fault as a whole. Messages are read a second time, as
    VARIANT, only where a field is NULL.
    """
    names = schema.fieldNames()
    text = F.col("value").cast("string")
    both = F.struct(text.alias("text"), F.from_json(text, schema).alias("typed"))
    # Out of a generator, so that each message is parsed once (see decode).
    rows = messages.select(*envelope, F.explode(F.array(both)).alias("m"))
    lacking = F.lit(False)
    for name in names:
        lacking = lacking | F.col("m.typed")[name].isNull()
    read = F.when(lacking, F.try_parse_json(F.col("m.text")))
    rows = rows.select(*envelope, "m", F.explode(F.array(F.struct(read.alias("doc")))).alias("v"))

    def fault(name: str) -> Column:
        path = f"$['{name}']"
        value = F.try_variant_get("v.doc", path, "variant")
        kind = F.when(F.col("m.typed")[name].isNull(), _kind(value))
        shown = F.try_variant_get("v.doc", path, "string")
        return F.struct(F.lit(name).alias("field"), kind.alias("kind"), shown.alias("found"))

    faults = F.explode(F.array(*map(fault, names)))
    return rows.select(*envelope, faults.alias("f")).where("f.kind IS NOT NULL").select(*envelope, "f.*")


def encode(df: DataFrame, *, envelope: Sequence[str] = ()) -> DataFrame:
    """Pack all columns into one JSON text column ``value``; NULL fields are left out."""
    fields = [c for c in df.columns if c not in envelope]
    return df.select(*envelope, F.to_json(F.struct(*fields)).alias("value"))
