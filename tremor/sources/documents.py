"""A document source: folders of JSON lines, as document stores dump them, with filters sent to the reader.

``register(spark)`` makes the format ``event_documents`` known to a session:

    spark.read.format("event_documents").schema(...).load(path).where("Type = 'Earthquake'")

Files are cut into byte ranges, one partition each; a line belongs to the range
that holds its first byte.  Comparisons of a column with a value reach the
reader, which drops other rows before they are handed to Spark; columns that
the schema does not name are never built.  Paths are those of Arrow's file
systems (local, ``hdfs://``, ``s3://``, ``gs://``), so executors open them
wherever they run.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as pj
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from tremor import schema as layouts

FORMAT = "event_documents"
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20
# What the reader can tell by itself; a null fulfils none of them, as in SQL.
COMPARISONS = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
}


@dataclass
class Split(ds.InputPartition):
    path: str
    start: int
    end: int


def whole_lines(file, start: int, end: int, block: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The lines that begin in ``[start, end)``, in blocks."""
    pos = start
    if start:
        # From the byte before: a line that begins at ``start`` has its predecessor's end there.
        file.seek(start - 1)
        pos = start - 1
        while (part := file.read(4096)) and (cut := part.find(b"\n")) < 0:
            pos += len(part)
        if not part:
            return
        pos += cut + 1
    file.seek(pos)
    rest = b""
    while pos < end and (part := file.read(min(block, end - pos))):
        pos += len(part)
        rest += part
        if (cut := rest.rfind(b"\n")) >= 0:
            yield rest[: cut + 1]
            rest = rest[cut + 1 :]
    while rest and (part := file.read(4096)):  # the last line ends beyond the range
        cut = part.find(b"\n")
        rest += part if cut < 0 else part[: cut + 1]
        if cut >= 0:
            break
    if rest:
        yield rest


class DocumentReader(ds.DataSourceReader):
    def __init__(self, kind: StructType, options: dict):
        self.kind, self.path = kind, options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            if isinstance(f, (*COMPARISONS, ds.In, ds.IsNotNull)) and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Split]:
        fs, at = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        info = fs.get_file_info(at)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(at, recursive=True))
        files = [f for f in found if f.is_file and f.size and not any(p[:1] in "_." for p in f.path[len(at) :].split("/") if p)]
        return [Split(f.path, a, min(a + self.split, f.size)) for f in sorted(files, key=lambda f: f.path) for a in range(0, f.size, self.split)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        fs = pafs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pafs.LocalFileSystem()
        kind = to_arrow_schema(self.kind)
        how = pj.ParseOptions(explicit_schema=kind, unexpected_field_behavior="ignore")
        with fs.open_input_file(partition.path) as file:
            for block in whole_lines(file, partition.start, partition.end):
                if not block.strip():
                    continue
                table = pj.read_json(pa.BufferReader(block), pj.ReadOptions(use_threads=False, block_size=len(block) + 1), how).select(kind.names)
                for f in self.filters:
                    table = table.filter(_mask(f, table.column(f.attribute[0])))
                yield from table.cast(kind).to_batches()


def _mask(f: ds.Filter, column: pa.ChunkedArray):
    if isinstance(f, ds.IsNotNull):
        return pc.is_valid(column)
    if isinstance(f, ds.In):
        return pc.is_in(column, pa.array([v for v in f.value if v is not None], column.type))
    return COMPARISONS[type(f)](column, pa.scalar(f.value, column.type))


class DocumentSource(ds.DataSource):
    """Without a schema the columns are those of the curated catalogue.

    A document that lacks a column has a null there, one with other columns
    loses them; a line that is no JSON, or a value of another type, is an error.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return StructType([*layouts.QUAKE.fields, StructField("Year", IntegerType())])

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentSource)


# The reader runs in tasks: its code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
