"""Functions of all rows of a window in their order, without holding a window whole.

The rows of a (key, window) are cut into pieces by time, sized by volume; a pandas
function sees one ordered piece and gives one row for it.  A second function merges a
window's pieces, in order, to the result: it sees a row for about every ``CHUNK_ROWS``
rows.  A function fits if a piece can be told by a bounded summary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from riverbed.functions.time import epoch_micros
from riverbed.operators.running import CHUNK_ROWS, volume_chunk


def whole_window(df: DataFrame, keys: Sequence[str], time_col: str, ties: Sequence[str], piece: Callable[[pd.DataFrame], dict],
                 piece_schema: str, merge: Callable[[pd.DataFrame], dict], result_schema: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``keys`` and the columns of ``result_schema``, a row per group.  Rows are ordered by
    ``time_col`` and then ``ties``; rows of one instant are in one piece.  Rows without a time
    make a piece of their own, before the others."""
    keys = list(keys)
    key_ddl = ", ".join(f"`{k}` {dict(df.dtypes)[k]}" for k in keys)
    cut = df.withColumn("_piece", F.coalesce(volume_chunk(df, epoch_micros(time_col), rows), F.lit(-1)).cast("long"))
    pieces = _fold_groups(cut, [*keys, "_piece"], [time_col, *ties], piece, f"{key_ddl}, _piece long, {piece_schema}")
    return _fold_groups(pieces, keys, ["_piece"], merge, f"{key_ddl}, {result_schema}")


def _fold_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """``keys`` and the row that ``fn`` gives for each group's rows in their order.

    Groups lie one after the other in sorted partitions and are cut out of Arrow batches: a
    call of Python is for a batch and not for a group, however many small groups there are.
    A task holds a batch and one group."""
    out = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out.fields])
        held: list[pa.Table] = []

        def results(done: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            values, ends = done.to_pandas(), np.append(starts[1:], done.num_rows)
            found = [fn(values.iloc[a:b]) for a, b in zip(starts, ends, strict=True)]
            first = done.select(keys).take(pa.array(starts))
            rest = pa.Table.from_pylist(found, schema=pa.schema([names.field(i) for i in range(len(keys), len(names))]))
            yield from pa.Table.from_arrays([*first.columns, *rest.columns], names=names.names).cast(names).to_batches()

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not rows.num_rows:
                continue
            if held and _starts(pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), rows]), keys).tolist() == [0]:
                held.append(rows)   # all of the batch goes on with the group held
                continue
            rows = pa.concat_tables([*held, rows]).combine_chunks()
            starts = _starts(rows, keys)
            # the last group may go on in the next batch
            held = [rows.slice(starts[-1])]
            if len(starts) > 1:
                yield from results(rows.slice(0, starts[-1]), starts[:-1])
        if held:
            yield from results(pa.concat_tables(held).combine_chunks(), np.zeros(1, "int64"))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group; null is a key."""
    changed = np.ones(rows.num_rows, bool)
    changed[1:] = False
    for k in keys:
        codes = rows.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        changed[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(changed)


#: A piece of rising runs: rows, first and last value, the runs at its two ends, the longest, the sum of rises.
RISE_PIECE = "n_rows long, first double, last double, head long, tail long, longest long, climb double"


def rise_of_piece(rows: pd.DataFrame) -> dict:
    v = rows["temp"].to_numpy(dtype="float64")
    step = np.diff(v)
    ends = np.append(np.flatnonzero(step <= 0) + 1, len(v))  # first row after each run
    lengths = np.diff(np.append(0, ends))
    return {"n_rows": len(v), "first": v[0], "last": v[-1], "head": int(lengths[0]), "tail": int(lengths[-1]),
            "longest": int(lengths.max()), "climb": float(step[step > 0].sum())}


def rise_of_pieces(pieces: pd.DataFrame) -> dict:
    """A run that ends one piece goes on into the next one if that begins higher."""
    n = longest = tail = 0
    climb, last = 0.0, None
    for p in pieces.itertuples(index=False):
        n, climb = n + p.n_rows, climb + p.climb
        joined = last is not None and last < p.first
        if joined:
            climb += p.first - last
        longest = max(longest, p.longest, (tail if joined else 0) + p.head)
        tail = p.tail + (tail if joined and p.tail == p.n_rows else 0)
        last = p.last
    return {"n_rows": n, "longest_rise": longest, "climb": climb}
