"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed import session

#: Rows sent to a Python worker at a time while a table is written; texts are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not have in any case."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def row_key(id_col: Column, text_col: Column) -> list[Column]:
    """Two 64-bit hashes that name a row by its id and text, both null-safe.

    Rows equal in id and text share a key; they always get equal results, so a
    join by this key neither loses nor confuses them."""
    parts = [id_col.isNull(), id_col.cast("string"), text_col.isNull(), text_col]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def ready(df: DataFrame) -> DataFrame:
    """Make the package importable by the Python workers of this session."""
    session.ship_package(df.sparkSession)
    return df


def parts(batches, rows: int = 512):
    """Arrow batches in runs of at most ``rows`` rows, so results don't pile up."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, with small Arrow
    batches meanwhile, so that executors hold few long texts at a time."""
    conf = df.sparkSession.conf
    was = conf.get(_BATCH)
    conf.set(_BATCH, str(min(int(was), BATCH_ROWS) if int(was) > 0 else BATCH_ROWS))
    try:
        return session.materialize(df, name)
    finally:
        conf.set(_BATCH, was)
