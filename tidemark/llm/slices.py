"""Further columns for rows with a text, worked out in Arrow slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

#: Bytes of text in a slice; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_ARROW: dict[DataType, pa.DataType] = {
    LongType(): pa.int64(), StringType(): pa.string(), ArrayType(LongType()): pa.list_(pa.int64()),
}


def sliced(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text each; rows without text count one byte."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()
    first = total = 0
    for i, length in enumerate(lengths):
        total += (length or 0) + 1
        if total >= size:
            yield batch.slice(first, i + 1 - first)
            first, total = i + 1, 0
    if first < len(lengths):
        yield batch.slice(first)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as bytes; a null is the empty text."""
    return [value or b"" for value in column(batch, name).cast(pa.binary()).to_pylist()]


def with_arrays(
    df: DataFrame, added: dict[str, DataType], work: Callable[[], Callable[[pa.RecordBatch], list]],
    drop: tuple[str, ...] = (), text: str = "text",
) -> DataFrame:
    """The rows of ``df`` with the columns ``added``.

    ``work`` is called once per task and gives a function from a slice to one list or Arrow array per
    added column.  Columns of ``df`` with those names, or in ``drop``, give way to them.
    """
    kept = [f for f in df.schema.fields if f.name not in added and f.name not in drop]
    names = [*(f.name for f in kept), *added]
    kinds = [_ARROW[kind] for kind in added.values()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for part in sliced(batch, text):
                own = [column(part, f.name) for f in kept]
                new = [a if isinstance(a, pa.Array) else pa.array(a, kind) for a, kind in zip(step(part), kinds)]
                yield pa.RecordBatch.from_arrays([*own, *new], names=names)

    return df.mapInArrow(run, StructType(kept + [StructField(n, kind) for n, kind in added.items()]))
