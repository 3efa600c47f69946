"""The wide-column action log as a Spark data source: range partitions, paged reads, key range and limit at the source.

The store keeps rows ``rowkey, it, ty`` as bytes in Parquet files, one folder a date (the key's first ten characters), sorted
by key.  ``spark.read.format("kvlog")`` lists the folders of the key range, one partition each; a partition opens only row
groups whose key range is touched and decodes ``page`` rows at a time, from the end if ``reverse``.  With ``limit`` a
partition stops as soon as it has that many rows (and all others of the last key), so a scan of the newest rows reads
the end of each date only; ``log_scan`` orders what is left and cuts it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "rowkey binary, it binary, ty binary"
PAGE = 1000  # rows a read, as the scan it stands for


def write_store(kv: DataFrame, path: str) -> None:
    """Store ``kv`` (rowkey, it, ty text) by date, sorted by key, as bytes; small row groups make range reads cheap."""
    order = ["dt", "rowkey", "it", "ty"]
    (kv.withColumn("dt", F.substring("rowkey", 1, 10)).repartitionByRange(*order).sortWithinPartitions(*order)
     .select(*[F.encode(c, "UTF-8").alias(c) for c in ("rowkey", "it", "ty")], "dt")
     .write.option("parquet.block.size", 1 << 20).partitionBy("dt").parquet(path))


class _Date(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.fs, self.root = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] or options["path"].startswith("file:") else (fs.LocalFileSystem(), options["path"])
        self.start, self.stop = options.get("start", "").encode(), options.get("stop", "").encode()
        self.reverse = str(options.get("reverse", "true")).lower() == "true"
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.page = int(options.get("page", PAGE))

    def partitions(self) -> list[_Date]:
        """One a date of the range; a date's files follow each other in key order."""
        out = []
        for entry in sorted(self.fs.get_file_info(fs.FileSelector(self.root)), key=lambda e: e.path):
            name = entry.path.rsplit("/", 1)[-1]
            if entry.type != fs.FileType.Directory or not name.startswith("dt="):
                continue
            date = name[3:].encode()
            if (self.start and date < self.start[:10]) or (self.stop and date > self.stop[:10]):
                continue
            files = [f.path for f in self.fs.get_file_info(fs.FileSelector(entry.path)) if f.path.endswith(".parquet")]
            if files:
                out.append(_Date(files))
        return out or [_Date([])]   # a reader has at least one partition

    def _groups(self, files: list[str]) -> list[tuple[bytes, bytes, str, int]]:
        """(least key, largest key, file, row group) of the row groups in range."""
        out = []
        for path in files:
            meta = pq.read_metadata(path, filesystem=self.fs)
            place = meta.schema.names.index("rowkey")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(place).statistics
                low, high = (s.min, s.max) if s is not None and s.has_min_max else (b"", b"\xff")
                low, high = (x.encode() if isinstance(x, str) else x for x in (low, high))
                if not (self.start and high < self.start) and not (self.stop and low >= self.stop):
                    out.append((low, high, path, g))
        return sorted(out, reverse=self.reverse)

    def _in_range(self, table: pa.Table) -> pa.Table:
        keep = None
        for bound, compare in ((self.start, pc.greater_equal), (self.stop, pc.less)):
            if bound:
                hit = compare(table.column("rowkey"), pa.scalar(bound, pa.binary()))
                keep = hit if keep is None else pc.and_(keep, hit)
        return table if keep is None else table.filter(keep)

    def read(self, partition: _Date) -> Iterator[pa.RecordBatch]:
        given, last = 0, None
        for low, high, path, group in self._groups(partition.files):
            if last is not None and given >= self.limit and (high < last if self.reverse else low > last):
                return
            with self.fs.open_input_file(path) as f:
                table = self._in_range(pq.ParquetFile(f).read_row_group(group, columns=["rowkey", "it", "ty"]))
            pages = range(0, table.num_rows, self.page)
            for at in reversed(pages) if self.reverse else pages:
                rows = table.slice(at, self.page)
                keys = rows.column("rowkey")
                if self.limit is not None and given >= self.limit:  # only rows of the last key are still wanted
                    rows = rows.filter(pc.equal(keys, pa.scalar(last, pa.binary())))
                    if rows.num_rows == 0:
                        break
                given += rows.num_rows
                if self.limit is not None and given >= self.limit and last is None:
                    last = keys[0 if self.reverse else len(keys) - 1].as_py()
                yield from rows.combine_chunks().to_batches()


class KvLogSource(DataSource):
    """``spark.read.format("kvlog")`` with options path, start, stop, reverse, limit, page."""

    @classmethod
    def name(cls) -> str:
        return "kvlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def log_scan(spark: SparkSession, path: str, start_row: str | None = None, stop_row: str | None = None, reverse: bool = True,
             limit: int | None = None, page: int = PAGE) -> DataFrame:
    """(ts, user_id, item_id, type) of ``[start_row, stop_row)`` in key order, at most ``limit`` rows."""
    spark.dataSource.register(KvLogSource)
    options = {"path": path, "start": start_row, "stop": stop_row, "reverse": str(reverse).lower(), "limit": limit, "page": page}
    rows = spark.read.format("kvlog").options(**{k: v for k, v in options.items() if v is not None}).load()
    told = rows.select(*[F.decode(c, "UTF-8").alias(c) for c in ("rowkey", "it", "ty")])
    told = told.orderBy(F.desc("rowkey") if reverse else F.asc("rowkey"), "it", "ty")
    if limit is not None:
        told = told.limit(limit)
    parts = F.split("rowkey", ",")
    return told.select(F.element_at(parts, 1).alias("ts"), F.element_at(parts, 2).cast("int").alias("user_id"), F.col("it").cast("int").alias("item_id"), F.col("ty").cast("tinyint").alias("type"))
