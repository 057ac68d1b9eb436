"""Chains over the ticks of a symbol, each link of which depends on the one before, in parallel blocks.

What a block of ticks does to the state that it finds is a step function of that state with few pieces. All blocks find
their functions at once; the functions are followed from block to block, a few rows each; and with the states that they
begin with all blocks do their work at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _in_order(t: pa.Table) -> pa.Table:
    return t.sort_by([("ts", "ascending"), ("trade_id", "ascending")])


def chained(ticks: DataFrame, columns: list[str], pieces: Callable[[pa.Table], list[tuple[int, int, int]]], number: Callable[[pa.Table, int], np.ndarray], start: int, out: str) -> DataFrame:
    """Ticks with the number of their link, from 0 for each symbol, as ``out``; _block, a struct (symbol, n), goes.

    pieces(ticks of a block with these columns, in order) gives (least, links, state): from a state of ``least`` on, the
    block ends so many links and leaves that state. The first piece, below all others, leaves the state it finds plus
    its own. number(ticks, state) counts the links ended before each tick. start: the state before a symbol's first tick.
    """
    def maps(key: tuple, t: pa.Table) -> pa.Table:
        rows = pieces(_in_order(t))
        symbol, n = key[0].as_py().values()
        return pa.table([pa.array([symbol] * len(rows), pa.string()), pa.array([n] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*rows))], ["symbol", "n", "least", "links", "state"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block, state, links, step = object(), None, start, 0, None
        for batch in batches:
            found: list[tuple] = []
            for s, b, least, more, left in zip(*(c.to_pylist() for c in batch.columns)):
                if (s, b) != (name, block):
                    if step is not None:
                        state, links = step[1], links + step[0]
                    if s != name:
                        state, links = start, 0
                    name, block = s, b
                    found.append((s, b, state, links))
                    step = (0, state + left)
                # Pieces come by ascending least: the last one that is reached counts.
                elif least <= state:
                    step = (more, left)
            if found:
                cols = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["symbol", "n", "_state", "_links"])

    functions = ticks.select("_block", "ts", "trade_id", *columns).groupBy("_block").applyInArrow(maps, "symbol string, n long, least long, links long, state long")
    states = functions.repartition("symbol").sortWithinPartitions("symbol", "n", "least").mapInArrow(follow, "symbol string, n long, _state long, _links long")
    # Keys are structs, in which nulls are equal: ticks without a symbol are a symbol of their own.
    d = ticks.join(states.select(F.struct("symbol", "n").alias("_block"), "_state", "_links"), "_block")
    schema = T.StructType([*[f for f in d.schema if f.name not in ("_state", "_links", "_block")], T.StructField(out, T.LongType())])

    def numbered(key: tuple, t: pa.Table) -> pa.Table:
        t = _in_order(t)
        ids = t.column("_links")[0].as_py() + number(t, t.column("_state")[0].as_py())
        return t.drop_columns(["_state", "_links", "_block"]).append_column(out, pa.array(ids, pa.int64()))

    return d.groupBy("_block").applyInArrow(numbered, schema)
