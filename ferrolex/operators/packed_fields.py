"""Splitting fields that hold several values into one row per value (problem 6).

Nulls, blank entries and entries with a single value give no rows. Repeated rows are split each under its own key.
Further columns of the input, whatever their names, are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.segment import split_packed
from ferrolex.session import spread

FIELDS = ("impurities", "impurity_concentration", "processing_history")
#: An entry without any of these holds one value; tested before the rows leave the JVM.
MAY_SEPARATE = r"[;|,/+&>→·•\s]"


def split_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict[str, list] = {}
    for batch in batches:
        keys, fields, positions, items = [], [], [], []
        for key, field, entry in zip(batch["row_key"], batch["field_name"], batch["entry"]):
            found = memo.get(entry)
            if found is None:
                found = split_packed(entry)
                if len(memo) > 50_000:
                    memo.clear()
                if len(entry) < 500:
                    memo[entry] = found
            for position, item in found:
                keys.append(key)
                fields.append(field)
                positions.append(position)
                items.append(item)
        yield pd.DataFrame({"row_key": keys, "field_name": fields, "pos": positions, "item": items})


def split_fields(df: DataFrame, key: str = "rec_key", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per value of the packed fields: key, field_name, pos, item. One narrow pass; only a table in fewer partitions than cores is spread first."""
    entries = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("string").alias("entry")) for f in fields]))
    long = (
        df.select(F.col(f"`{key}`").cast("bigint").alias("row_key"), entries.alias("e"))
        .select("row_key", "e.field_name", "e.entry")
        .where(F.col("entry").isNotNull() & F.trim("entry").rlike(MAY_SEPARATE))
    )
    rows = spread(long).mapInPandas(split_rows, "row_key bigint, field_name string, pos int, item string")
    return rows.withColumnRenamed("row_key", key)
