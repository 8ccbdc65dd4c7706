"""Normalisation of enumerations, confidences and renamed fields."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed, text


def enum(df: DataFrame, column: str, synonyms: dict[str, str], name: str,
         default: str | None = None) -> DataFrame:
    """Map synonyms of an enumerated value; unknown values become ``default``."""
    pairs = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    found = F.try_element_at(pairs, F.col(column))
    return df.withColumn(name, F.coalesce(found, F.lit(default)))


def confidence(df: DataFrame, column: str, name: str = "confidence",
               scale: dict[str, float] | None = None) -> DataFrame:
    """Confidence as a number from records that hold a number or a word."""
    pairs = F.create_map(*[F.lit(x) for p in (scale or fixed.CONFIDENCE_WORDS).items() for x in p])
    raw = text.blank_to_null(F.col(column).cast("string"))
    number = raw.try_cast("double")
    return df.withColumn(name, F.coalesce(number, F.try_element_at(pairs, F.lower(raw))))


def coalesce_alias(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Fold legacy columns into their successors and drop them."""
    for old, new in pairs.items():
        if old not in df.columns:
            continue
        sources = [c for c in (new, old) if c in df.columns]
        df = df.withColumn(new, F.coalesce(*[text.blank_to_null(c) for c in sources])).drop(old)
    return df
