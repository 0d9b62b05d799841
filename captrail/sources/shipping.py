"""Shards that Spark cannot list or open where they are: behind HTTP, in tar files, under path templates."""

from __future__ import annotations

import tarfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.paths import matching, store
from captrail.session import ship

from .fetch import Fetch

BLOCK = 1 << 24


def copy_files(files: DataFrame, fetch: Fetch, size: Callable[[str], int | None], folder: str, tasks: int, most: int = 50_000_000_000) -> DataFrame:
    """(path, target, n_bytes, error) of remote files (path), copied whole into a folder of the shared store, by ranges of BLOCK bytes.

    A file is a task's row, files dealt to tasks evenly. It takes its name when it is whole, and one that is there in its full size is not
    copied again, so a run that broke off goes on; with fetch.patient() transient errors are tried again. Files larger than
    `most` or of unknown size, and null paths, are rows with an error."""
    ship(files.sparkSession)

    def copied(path: str | None) -> tuple:
        try:
            if path is None:
                raise ValueError("no path")
            n = size(path)
            if n is None or n > most:
                raise ValueError(f"size {n} is over {most} or unknown")
            fs, base = store(folder)
            target = f"{base}/{path.split('://', 1)[-1].lstrip('/')}"
            if fs.get_file_info(target).size != n:
                fs.create_dir(target.rsplit("/", 1)[0])
                part = f"{target.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(part, compression=None) as out:
                    for start in range(0, n, BLOCK):
                        got = fetch(path, start, min(n, start + BLOCK) - 1)
                        if len(got) != min(n, start + BLOCK) - start:
                            raise OSError("short read")
                        out.write(got)
                fs.move(part, target)
            return path, target, n, None
        except Exception as e:  # noqa: BLE001  a failure is a row
            return path, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
        for b in batches:
            for p in b.column("path").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(copied(p), kinds, strict=True)], names=["path", "target", "n_bytes", "error"])

    return files.select("path").distinct().repartition(tasks).mapInArrow(run, "path string, target string, n_bytes long, error string")


def read_remote(spark: SparkSession, files: DataFrame, fetch: Fetch, size: Callable[[str], int | None], folder: str, tasks: int) -> DataFrame:
    """The rows of remote Parquet files (path), which are copied first; an error if one of them could not be."""
    copy_files(files, fetch, size, folder, tasks).write.mode("overwrite").parquet(f"{folder}/_copies")
    done = spark.read.parquet(f"{folder}/_copies")
    bad = done.filter("error is not null").select("path", "error").first()
    if bad is not None:
        raise OSError(f"{bad.path}: {bad.error}")
    return spark.read.option("recursiveFileLookup", True).parquet(folder)


def untar(spark: SparkSession, pattern: str, folder: str, ending: str = "") -> DataFrame:
    """(tar, member, target, n_bytes, error): the regular files of tar files, plain or compressed, that end so, written below folder.

    A tar file is one task's, which streams it: neither a tar file nor a member is held. Members keep their own file name only, below
    a folder for their tar file, so none can leave it. A damaged tar file gives its good members and a row with the error."""
    ship(spark)
    tars = spark.createDataFrame([(p,) for p in matching(spark, pattern)], "path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
        to, base = store(folder)
        row = lambda *values: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["tar", "member", "target", "n_bytes", "error"])
        for b in batches:
            for path in b.column("path").to_pylist():
                at = f"{base}/{path.rsplit('/', 1)[-1]}"
                to.create_dir(at)
                fs, inner = store(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
                try:
                    with fs.open_input_stream(inner, compression=None) as f, tarfile.open(fileobj=f, mode="r|*") as tar:
                        for m in tar:
                            name = m.name.rsplit("/", 1)[-1]
                            if m.isfile() and name.endswith(ending):
                                part = f"{at}/.{uuid.uuid4().hex}"
                                with to.open_output_stream(part, compression=None) as out:
                                    source = tar.extractfile(m)
                                    while block := source.read(1 << 20):
                                        out.write(block)
                                to.move(part, f"{at}/{name}")
                                yield row(path, m.name, f"{at}/{name}", m.size, None)
                except (OSError, tarfile.TarError, EOFError) as e:
                    yield row(path, None, None, None, f"{type(e).__name__}: {e}")

    return tars.repartition(max(1, tars.count())).mapInArrow(run, "tar string, member string, target string, n_bytes long, error string")


def discover_by_templates(spark: SparkSession, templates: list[str], collections: DataFrame) -> DataFrame:
    """(collection, year, path) of the shards that path templates with {collection} and {year} name, for the collections (collection, one row
    each) of a catalog. The first template under which a collection has any file is the one that counts for it.

    The collections of a catalog, some hundred, and the names of their shards pass the driver, as with any listing."""
    from captrail.functions import urls

    found = []
    for r in collections.select("collection", urls.collection_year("collection").alias("year")).distinct().orderBy("collection").toLocalIterator():
        for t in templates:
            paths = matching(spark, t.format(collection=r.collection, year=r.year))
            if paths:
                found += [(r.collection, r.year, p) for p in paths]
                break
    return spark.createDataFrame(found, "collection string, year string, path string")
