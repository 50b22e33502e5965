"""Range buckets with sampled splitters, sorted locally and compared across their borders.

Spark's range partitioner samples the keys and picks the splitters. As the splitters also
see the tie-breaking columns, rows of one hot key are spread over many buckets. Inside
a bucket, a multikey quicksort orders the rows; equal keys are then neighbours, or sit on
the two sides of a border, where the buckets' outermost rows are compared once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by several integer keys: sort by the first, then only the runs that tie by
    the next, and so on (multikey quicksort, one key column at a time)."""
    order = np.argsort(keys[0], kind="quicksort")
    group = np.zeros(len(order), dtype=np.int64)
    for depth, key in enumerate(keys):
        if depth:
            tied = np.zeros(len(order), dtype=bool)
            tied[1:] = group[1:] == group[:-1]
            tied[:-1] |= tied[1:]
            at = np.flatnonzero(tied)
            if not len(at):
                break
            sub = order[at]
            order[at] = sub[np.lexsort((key[sub], group[at]))]
        now = key[order]
        step = np.ones(len(order), dtype=np.int64)
        step[0:1] = 0
        step[1:] = (now[1:] != now[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(step)
    return order


def repeats(df: DataFrame, payload: list[str], buckets: int) -> DataFrame:
    """Rows of (core, u1, u2, *payload), all longs, whose core another row shares.

    Returns payload, ``whole``: true if another row shares core, u1 and u2 as well, and
    ``open``: true for rows that aren't whole, and for one row at least of each (core, u1,
    u2) that has such rows beside it under its core (their partners in a finer look).
    """
    cols = ["core", "u1", "u2", *payload]
    ranged = df.select(*cols).repartitionByRange(max(1, buckets), *cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        arrays = [t.column(c).to_numpy() for c in cols]
        keys = arrays[:3]
        order = multikey_order(keys)
        keys = [k[order] for k in keys]
        same_core = keys[0][1:] == keys[0][:-1]
        same_all = same_core & (keys[1][1:] == keys[1][:-1]) & (keys[2][1:] == keys[2][:-1])
        core, whole = np.zeros(len(order), bool), np.zeros(len(order), bool)
        core[1:] |= same_core
        core[:-1] |= same_core
        whole[1:] |= same_all
        whole[:-1] |= same_all
        border = np.zeros(len(order), bool)
        border[[0, -1]] = True
        group = np.concatenate([[0], np.cumsum(~same_core)])
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[~whole]] = True
        mixed[[0, -1]] = True  # these may go on in the next bucket
        lead = np.ones(len(order), bool)
        lead[1:] = ~same_all
        is_open = ~whole | (lead & mixed[group])
        keep = np.flatnonzero(core | border)
        out = [k[keep] for k in keys] + [a[order[keep]] for a in arrays[3:]] + [core[keep], whole[keep], is_open[keep], border[keep]]
        for lo in range(0, len(keep), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000]) for x in out],
                                             names=[*cols, "same", "whole", "open", "border"])
        del got, t, arrays, keys, out
        pa.default_memory_pool().release_unused()

    schema = ", ".join(f"{c} long" for c in cols) + ", same boolean, whole boolean, open boolean, border boolean"
    found = staged(ranged.mapInArrow(run, schema), "repeats")
    inner = found.where("same and not border").select(*payload, "whole", "open")
    # Two rows for each bucket: their number is that of the buckets, not of the data.
    outer = found.where("border")
    w = Window.orderBy("core", "u1", "u2", *payload)

    def equal(name: str, step):
        return F.coalesce(step(name).over(w) == F.col(name), F.lit(False))

    before = [equal(c, lambda n: F.lag(n)) for c in ("core", "u1", "u2")]
    after = [equal(c, lambda n: F.lead(n)) for c in ("core", "u1", "u2")]
    outer = outer.select(*payload, (F.col("same") | before[0] | after[0]).alias("same"),
                         (F.col("whole") | (before[0] & before[1] & before[2]) | (after[0] & after[1] & after[2])).alias("whole"),
                         F.lit(True).alias("open"))
    return inner.unionByName(outer.where("same").select(*payload, "whole", "open"))
