"""JSON texts as variants: parsed once, then read by path as often as needed.

A variant column can be stored in parquet. A text that is no JSON is null, and so is a field that is absent or does not
fit the type asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.business import OWN_PRODUCT, THIRD_PARTY_PRODUCT


def parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def field(variant: Column, path: str, kind: str = "string") -> Column:
    """The value at a path such as ``$.a.b[0]``."""
    return F.try_variant_get(variant, path, kind)


def with_variant(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column`` as the variant ``name``. It passes a one-element generator, so that the fields read from it do
    not parse the text again each."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(parsed(F.col(column)))).alias(name))


def product_type_of(variant: Column) -> Column:
    """The label of a product's type, as ``business.product_type`` gives it for the text."""
    return F.when(field(variant, "$.product_type") == "0", F.lit(OWN_PRODUCT)).otherwise(F.lit(THIRD_PARTY_PRODUCT))


def record_variant(*columns: str) -> Column:
    """A row's columns as one variant, whose fields keep their types."""
    return F.to_variant_object(F.struct(*columns))
