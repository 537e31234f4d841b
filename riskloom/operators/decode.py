"""Message values to typed columns, bad messages set apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions.casts import lenient_double, lenient_int, missing_to_null, strip
from riskloom.spec import FeatureSpec

_CORRUPT = "_corrupt"
MALFORMED = "malformed"


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def typed(name: str, integers: frozenset[str], doubles: frozenset[str], source: Column) -> Column:
    if name in integers:
        return lenient_int(source).alias(name)
    if name in doubles:
        return lenient_double(source).alias(name)
    return missing_to_null(source).alias(name)


def cast_fields(df: DataFrame, integers: Sequence[str] = (), doubles: Sequence[str] = ()) -> DataFrame:
    """Cast the named string columns leniently, all in one projection."""
    ints, dbls = frozenset(integers), frozenset(doubles)
    return df.select(*[typed(c, ints, dbls, F.col(f"`{c}`")) if c in ints | dbls else F.col(f"`{c}`")
                       for c in df.columns])


def decode_messages(
    envelope: DataFrame,
    fields: Sequence[str],
    integers: Sequence[str] = (),
    doubles: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One typed row per message: the ``keep`` columns of the envelope, every field, and
    ``malformed``, true where the value is blank or is not one JSON object."""
    schema = string_schema(fields).add(_CORRUPT, StringType())
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    ints, dbls = frozenset(integers), frozenset(doubles)
    blank = strip(F.coalesce(F.col("_text"), F.lit(""))) == ""  # the parser does not flag these
    flag = blank | F.col("_record").getField(_CORRUPT).isNotNull()
    return envelope.select(*keep, text.alias("_text"), parsed.alias("_record")).select(
        *keep,
        *[typed(f, ints, dbls, F.col("_record").getField(f)) for f in fields],
        flag.alias(MALFORMED),
        F.when(flag, F.col("_text")).alias("malformed_text"),
    )


def decode_records(
    envelope: DataFrame, spec: FeatureSpec, with_keys: bool = True, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The readable records of a batch or stream of messages, typed as the spec says, and
    the quarantine. Base records come without the key fields."""
    fields = [*(spec.keys if with_keys else ()), *spec.record_fields, spec.target]
    decoded = decode_messages(envelope, fields, spec.integer_fields, spec.double_fields, keep)
    return well_formed(decoded), malformed(decoded, keep)


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col(MALFORMED)).drop(MALFORMED, "malformed_text")


def malformed(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The quarantine output: the text of every message that could not be read."""
    return decoded.filter(F.col(MALFORMED)).select(*keep, "malformed_text")
