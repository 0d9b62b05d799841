"""Archives of gzip members: writing them, and a data source that reads members by a listing of their places."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from captrail.paths import store
from captrail.schemas import RECORD_DDL
from captrail.session import ship


def write_archives(members: DataFrame, folder: str, key: str = "warc_filename", order: str = "page_id", data: str = "bytes") -> DataFrame:
    """Writes each key's members one after the other, in the given order, to the file <folder>/<key>; (key, order, warc_offset, warc_length).

    The listing is computed by the writing, so it is written by whoever calls this, once. A file takes its name when it is whole:
    a task that is lost leaves a temporary file, and its successor writes the same bytes. Null members have length 0."""
    ship(members.sparkSession)
    kind = members.schema[order].dataType.simpleString()
    dealt = members.select(key, order, data).repartition(key).sortWithinPartitions(key, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(folder)
        name, out, at, temporary = None, None, 0, None

        def close() -> None:
            if out is not None:
                out.close()
                if fs.get_file_info(f"{base}/{name}").type != FileType.NotFound:
                    fs.delete_file(f"{base}/{name}")
                fs.move(temporary, f"{base}/{name}")

        for b in batches:
            starts, lengths = [], []
            for k, blob in zip(b.column(key).to_pylist(), b.column(data).to_pylist(), strict=True):
                if k != name:
                    close()
                    name, at, temporary = k, 0, f"{base}/.{uuid.uuid4().hex}"
                    fs.create_dir(f"{base}/{k}".rsplit("/", 1)[0])
                    out = fs.open_output_stream(temporary, compression=None)
                starts.append(at)
                lengths.append(len(blob or b""))
                out.write(blob or b"")
                at += lengths[-1]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column(order), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], names=[key, order, "warc_offset", "warc_length"])
        close()

    return dealt.mapInArrow(run, f"`{key}` string, `{order}` {kind}, warc_offset long, warc_length long")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class ArchiveSource(DataSource):
    """Members of archives as rows: spark.read.format("archive").option("path", folder).option("listing", parquet).load().

    path: the folder of the archives. listing: Parquet files with warc_filename, warc_offset and warc_length, best sorted by them. A
    partition is a row group of the listing, so archives are cut at member offsets and the planner reads footers only. Columns:
    the place, the member's bytes and its parsed record. A schema given to the reader chooses columns: without bytes and
    record nothing is fetched, without a record nothing is unpacked. Filters on warc_filename skip row groups of the listing.
    A member that cannot be read or parsed is a row with its error."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return f"warc_filename string, warc_offset long, warc_length long, bytes binary, {RECORD_DDL}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(self.options["path"], self.options["listing"], schema, int(self.options.get("gap", "256000")), int(self.options.get("slice", "25000000")))


class Group(InputPartition):
    def __init__(self, file: str, group: int):
        self.file, self.group = file, group


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, listing: str, schema: StructType, gap: int, most: int):
        self.path, self.listing, self.columns, self.gap, self.most = path, listing, schema, gap, most
        self.names: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is None or tuple(f.attribute) != ("warc_filename",):
                yield f
            else:
                self.names = set(values) if self.names is None else self.names & set(values)

    def partitions(self) -> Sequence[InputPartition]:
        """The row groups of the listing that may hold a wanted archive, by their statistics."""
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        fs, base = store(self.listing)
        out = []
        for f in sorted(fs.get_file_info(FileSelector(base, recursive=True)), key=lambda f: f.path):
            if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")):
                meta = pq.ParquetFile(fs.open_input_file(f.path)).metadata
                at = meta.schema.names.index("warc_filename")
                for g in range(meta.num_row_groups):
                    stats = meta.row_group(g).column(at).statistics
                    if self.names is None or stats is None or not stats.has_min_max or any(stats.min <= n <= stats.max for n in self.names):
                        out.append(Group(f.path, g))
        return out

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        from captrail.operators.warc import record

        wanted = self.columns.fieldNames()
        parsed = [n for n in wanted if n not in ("warc_filename", "warc_offset", "warc_length", "bytes")]
        fs, _ = store(self.listing)
        places = pq.ParquetFile(fs.open_input_file(partition.file)).read_row_group(partition.group, ["warc_filename", "warc_offset", "warc_length"])
        rows = [p for p in zip(*[places[c].to_pylist() for c in places.column_names], strict=True) if self.names is None or p[0] in self.names]
        fetched = self._members(sorted(rows, key=lambda p: (p[0] or "", p[1] or 0))) if "bytes" in wanted or parsed else ((p, None, None) for p in rows)
        held, size = [], 0
        for (name, o, n), blob, error in fetched:
            row = {"warc_filename": name, "warc_offset": o, "warc_length": n, "bytes": blob}
            if parsed:
                row |= record(blob) | ({"error": error} if error else {})
            held.append([list(row[c].items()) if isinstance(row[c], dict) else row[c] for c in wanted])
            size += len(blob or b"")
            if size > 1 << 24 or len(held) == 1000:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _arrow(f.dataType)) for k, f in enumerate(self.columns.fields)], names=self.columns.fieldNames())

    def _members(self, places: list[tuple]) -> Iterator[tuple]:
        """((archive, offset, length), bytes, error) in order; neighbours within the gap are read at once, up to a slice."""
        fs, base = store(self.path)
        k = 0
        while k < len(places):
            name, start, n = places[k]
            if name is None or start is None or n is None or start < 0 or n <= 0:
                yield places[k], None, None if n == 0 else "bad place"  # an empty member is told by record()
                k += 1
                continue
            end, last = start + n, k + 1
            while last < len(places) and places[last][0] == name and (places[last][2] or 0) > 0 and places[last][1] - end <= self.gap and places[last][1] + places[last][2] - start <= self.most:
                end = max(end, places[last][1] + places[last][2])
                last += 1
            try:
                with fs.open_input_file(f"{base}/{name}") as f:
                    blob, error = f.read_at(end - start, start), None
            except OSError as e:
                blob, error = b"", f"{type(e).__name__}: {e}"
            for p in places[k:last]:
                part = blob[p[1] - start : p[1] - start + p[2]]
                yield p, *((part, None) if len(part) == p[2] else (None, error or "short read"))
            k = last


def register(spark: SparkSession) -> None:
    """Makes the format "archive" known to a session, whose Python sources then take filters."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)


def sorted_listing(listing: DataFrame, path: str, partitions: int, key: str = "warc_filename") -> None:
    """A listing in the order that ArchiveSource reads best."""
    order = [F.col(key), F.col("warc_offset")]
    listing.repartitionByRange(partitions, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
