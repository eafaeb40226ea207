"""A connector to a store of parquet files, as a Python data source that answers filters itself.

The store is read with Arrow, one task per row group.  Filters that Spark pushes are taken twice: row groups
whose statistics rule them out are never listed as partitions, and the rest is filtered before a row leaves
the reader.  Filters the reader cannot answer exactly as Spark would (on floating point numbers, where NaN
compares differently, and on nested columns) go back to Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual, Not, StringStartsWith,
)
from pyspark.sql.types import BooleanType, ByteType, DateType, IntegerType, LongType, ShortType, StringType, StructType, TimestampNTZType

FORMAT = "tidemark_files"
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Types whose comparisons mean the same to Arrow and to Spark.
_EXACT = (BooleanType, ByteType, ShortType, IntegerType, LongType, StringType, DateType, TimestampNTZType)
_COMPARE = {
    EqualTo: lambda c, v: c == v, GreaterThan: lambda c, v: c > v, GreaterThanOrEqual: lambda c, v: c >= v,
    LessThan: lambda c, v: c < v, LessThanOrEqual: lambda c, v: c <= v, In: lambda c, v: c.isin(list(v)),
    StringStartsWith: lambda c, v: pc.starts_with(c, v),
}


def as_expression(filter_: Filter, schema: StructType) -> ds.Expression | None:
    """The Arrow form of a filter; None if it would not mean the same."""
    if isinstance(filter_, Not):
        child = filter_.child
        inner = None if isinstance(child, In) and None in child.value else as_expression(child, schema)
        if inner is None or isinstance(child, (IsNull, IsNotNull, Not)):
            return None if inner is None else ~inner
        return ds.field(child.attribute[0]).is_valid() & ~inner      # a null is neither equal nor unequal
    path = getattr(filter_, "attribute", ())
    if len(path) != 1 or path[0] not in schema.fieldNames():
        return None
    column, kind = ds.field(path[0]), schema[path[0]].dataType
    if isinstance(filter_, (IsNull, IsNotNull)):
        return column.is_null() if isinstance(filter_, IsNull) else column.is_valid()
    make = _COMPARE.get(type(filter_))
    if make is None or not isinstance(kind, _EXACT) or getattr(filter_, "value", None) is None:
        return None
    if isinstance(filter_, In):
        return make(column, [v for v in filter_.value if v is not None])
    return make(column, filter_.value)


@dataclass
class RowGroup(InputPartition):
    path: str
    number: int


class StoreReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.filters = path, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            if as_expression(one, self.schema) is None:
                yield one
            else:
                self.filters.append(one)

    def _condition(self) -> ds.Expression | None:
        out = None
        for one in self.filters:
            own = as_expression(one, self.schema)
            out = own if out is None else out & own
        return out

    def partitions(self) -> list[RowGroup]:
        """The row groups that the statistics do not rule out."""
        store, path = fs.FileSystem.from_uri(self.path)
        condition, out = self._condition(), []
        for fragment in ds.dataset(path, filesystem=store, format="parquet").get_fragments():
            groups = fragment.split_by_row_group(condition) if condition is not None else fragment.split_by_row_group()
            out += [RowGroup(fragment.path, group.row_groups[0].id) for group in groups]
        return out

    def read(self, partition: RowGroup | None) -> Iterator[pa.RecordBatch]:
        if partition is None:       # Spark's stand-in when no partition is left
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        with store.open_input_file(partition.path) as file:
            table = pq.ParquetFile(file).read_row_group(partition.number, columns=self.schema.fieldNames())
        condition = self._condition()
        yield from (table if condition is None else table.filter(condition)).to_batches()


class FileStore(DataSource):
    """Options: ``path``, a URI or folder, and a schema, which the reader asks for."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> StoreReader:
        return StoreReader(self.options["path"], schema)


def read_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The store as a frame; filters and SQL on it are pushed to the reader.

    Turns filter push-down to Python sources on for the session, as the source needs it.
    """
    spark.dataSource.register(FileStore)
    spark.conf.set(_PUSHDOWN, "true")
    return spark.read.format(FORMAT).schema(schema).option("path", path).load()


def query_store(spark: SparkSession, path: str, schema: StructType, query: str) -> DataFrame:
    """Rows of a query over the store, which its text calls ``{source}``; what can be pushed is."""
    return spark.sql(query, source=read_store(spark, path, schema))


def copy_store(
    spark: SparkSession, path: str, schema: StructType, query: str, target: str, target_path: str | None = None
) -> DataFrame:
    """Copy the result of a query over the store into a table and return that table."""
    writer = query_store(spark, path, schema, query).write.mode("overwrite")
    (writer.option("path", target_path) if target_path else writer).saveAsTable(target)
    return spark.table(target)
