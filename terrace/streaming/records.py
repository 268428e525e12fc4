"""Records on a stream: a key and a JSON payload in bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.contracts import PayloadSpec
from terrace.operators.clean import type_payload, typed_value

RECORD_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("data", T.BinaryType())]
)
CORRUPT = "_corrupt_record"
VALID, REJECTED = "valid", "rejected"


def to_records(
    df: DataFrame, key: str, default_key: str = "default", omit: Sequence[str] = ()
) -> DataFrame:
    """One record per row: its id as key, all its columns as JSON.

    Columns of ``omit`` are not in the JSON but stay next to it.
    """
    key_value = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    columns = [c for c in df.columns if c not in omit]
    payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(
        F.coalesce(key_value, F.lit(default_key)).alias("key"),
        payload.cast("binary").alias("data"),
        *omit,
    )


def parse_records(
    records: DataFrame, spec: PayloadSpec, data: str = "data", keep: Sequence[str] = ()
) -> DataFrame:
    """Flatten and type the payload, and mark what is no record. Columns of ``keep`` stay.

    ``record_status`` is ``rejected`` for text that is no JSON object or has none of the
    fields, and where a typed field or the year has text that does not fit; only then
    ``raw_record`` holds the text as it came. A year that does not fit is null, so that
    the year of the stored table stays a number.
    """
    schema = spec.schema().add(CORRUPT, T.StringType())
    text = F.col(data).cast("string")
    parsed = records.select(
        text.alias("raw_record"),
        F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("payload"),
        *keep,
    ).select("payload.*", "raw_record", *keep)
    nothing = F.coalesce(*[F.col(c) for c in spec.fields]).isNull()
    year = F.nullif(F.col(spec.partition_by), F.lit(""))
    no_year = ~year.rlike(r"^[0-9]{1,4}\z")
    typed = dict(spec.typed)
    misfits = [
        F.nullif(F.col(c), F.lit("")).isNotNull() & typed_value(c, kind).isNull()
        for c, kind in typed.items()
    ]
    rejected = F.col(CORRUPT).isNotNull() | nothing | F.coalesce(no_year, F.lit(False))
    for misfit in misfits:
        rejected = rejected | misfit
    marked = parsed.select(
        *[
            F.when(~no_year, year).alias(c) if c == spec.partition_by else F.col(c)
            for c in spec.fields
        ],
        F.when(rejected, F.col("raw_record")).alias("raw_record"),
        F.when(rejected, REJECTED).otherwise(VALID).alias("record_status"),
        *keep,
    )
    return type_payload(marked, spec)
