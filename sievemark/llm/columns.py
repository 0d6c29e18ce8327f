"""Passing a table's own columns through a Python step, whatever their names are."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def give_back() -> None:
    """Return freed memory to the system: at a task's end, as workers are kept for the next."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library frees by itself
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mapped(df: DataFrame, asked: list[Column], run: Callable, new: list[tuple[str, str]]) -> DataFrame:
    """``df`` with the columns ``new`` (name, type), which ``run(asked, kept)`` makes:
    it gets an iterator of (arrays of ``asked``, the batch's other columns) and yields
    such pairs of (new arrays, other columns). Columns of the new names are replaced.

    Inside, columns go by their place, so dots, quotes and clashes do no harm.
    """
    names = {n.lower() for n, _ in new}
    kept = [c for c in df.columns if c.lower() not in names]
    n, m = len(asked), len(kept)
    inside = df.select(*(a.alias(f"x{i}") for i, a in enumerate(asked)), *(quoted(c).alias(f"c{i}") for i, c in enumerate(kept)))
    schema = ", ".join([f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)] + [f"y{i} {kind}" for i, (_, kind) in enumerate(new)])
    labels = [f"c{i}" for i in range(m)] + [f"y{i}" for i in range(len(new))]

    def batches(stream):
        import pyarrow as pa

        for made, rest in run((b.columns[:n], b.columns[n:]) for b in stream):
            yield pa.RecordBatch.from_arrays([*rest, *made], names=labels)
        give_back()

    return inside.mapInArrow(batches, schema).toDF(*kept, *(name for name, _ in new))
