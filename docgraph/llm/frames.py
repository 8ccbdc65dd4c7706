"""Entry and exit of Arrow batches: which columns an operator sees, and how it makes rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def pair(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def each(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``work`` on every Arrow batch; it yields column dictionaries in the order of ``schema``."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else
                     c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip((columns[f.name] for f in arrow), arrow)], schema=arrow)

    return df.mapInArrow(run, kind)
