"""Stream messages: decode JSON payloads, encode rows as keyed JSON (SRC-9, SNK-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions import keys as fk


def decode_messages(df: DataFrame, col: str = "data", schema: T.StructType | str | None = None,
                    keep: Sequence[str] = (), required: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-9: parse the JSON text in ``col`` -> (typed rows, quarantine).

    A row is quarantined when the text does not parse or a ``required`` field (default:
    all fields) is NULL. ``keep`` columns are carried along.
    """
    if schema is None:
        raise ValueError("schema is required")
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in st.fields]
    parsed = df.select(*keep, F.col(col).alias("_raw"),
                       F.from_json(F.col(col), st, {"mode": "PERMISSIVE"}).alias("_m"))
    ok_cond = F.col("_m").isNotNull()
    for n in (required if required is not None else names):
        ok_cond = ok_cond & F.col("_m." + n).isNotNull()
    parsed = parsed.withColumn("_ok", F.coalesce(ok_cond, F.lit(False)))
    good = parsed.where("_ok").select(*keep, *[F.col("_m." + n).alias(n) for n in names])
    bad = parsed.where(~F.col("_ok")).select(*keep, F.col("_raw").alias(col))
    return good, bad


def encode_messages(df: DataFrame, data_type: str = "trades", cols: Sequence[str] | None = None) -> DataFrame:
    """SNK-4: (stream_key, data) with ``data`` = the row as JSON text."""
    body = F.to_json(F.struct(*(cols or df.columns)))
    return df.select(fk.stream_key(data_type).alias("stream_key"), body.alias("data"))
