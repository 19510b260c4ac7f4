"""Sinks: Parquet in a spatial layout, GeoParquet with metadata in its footers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import spatial
from plinth.sources import storage

ROW_GROUP = 100_000


def with_attribution(df: DataFrame, column: str, attribution: dict) -> DataFrame:
    """Attribution as the column's metadata, which Spark's Parquet files keep."""
    return df.withColumn(column, F.col(column).alias(column, metadata={"attribution": json.dumps(attribution)}))


def cell(x: Column, y: Column, degrees: float) -> Column:
    """The name of a square cell of so many degrees."""
    part = lambda v: F.floor(v / degrees).cast("string")
    return F.concat(part(x), F.lit("_"), part(y))


def nonempty(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows with a geometry that has vertices."""
    return df.filter(F.col(geometry).isNotNull() & ~spatial.st_isempty(geometry))


def in_curve_order(df: DataFrame, geometry: str = "geometry", bounds: tuple[float, float, float, float] = spatial.WORLD) -> DataFrame:
    """Ranges of a Hilbert curve, each in its order, so that statistics of boxes prune row groups."""
    key = "".join(["curve", *df.columns])  # no column has this name
    return df.withColumn(key, spatial.st_hilbert(F.col(geometry), bounds)).repartitionByRange(key).sortWithinPartitions(key).drop(key)


def write_parquet(df: DataFrame, path: str, order: list[str] | None = None, mode: str = "errorifexists") -> None:
    """ZSTD Parquet in row groups of ROW_GROUP rows; ``order`` clusters it for pruning by statistics."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode(mode).option("compression", "zstd").option("parquet.block.row.count.limit", str(ROW_GROUP)).parquet(path)


def _folder(value: str | None) -> str:
    """A partition's folder, named as Spark does."""
    return "cell_partition=" + ("".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value) if value else "__HIVE_DEFAULT_PARTITION__")


def write_cells(df: DataFrame, path: str, coarse: Column, fine: Column, mode: str = "errorifexists", together: int = ROW_GROUP) -> None:
    """A folder for each coarse cell, rows in order of the fine cell. Cells are dealt whole, each to one task and file; only one of over ``together`` rows
    is dealt, by its fine cells, to as many tasks as it fills. The keys aren't in the files.

    Cells are many and small, and Spark's own writer takes some ten milliseconds for each file. A task writes under names of its own and then
    renames, so one that runs twice leaves one file."""
    spark = df.sparkSession
    if storage.exists(spark, path):
        if mode != "overwrite":
            raise FileExistsError(f"{path} already exists")
        storage.remove(spark, path)
    keyed = df.withColumns({"cell_partition": coarse.cast("string"), "_fine": fine})
    dense = keyed.groupBy("cell_partition").count().filter(F.col("count") > together).select(F.col("cell_partition").alias("_dense"), F.ceil(F.col("count") / together).cast("int").alias("_parts"))
    salted = keyed.join(dense, F.col("cell_partition").eqNullSafe(F.col("_dense")), "left").withColumn("_salt", F.pmod(F.xxhash64("_fine"), F.coalesce("_parts", F.lit(1))))
    laid = salted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell_partition", "_salt").sortWithinPartitions("cell_partition", "_fine")
    laid = laid.drop("_fine", "_salt", "_coarse", "_sort", "_dense", "_parts")
    footer = {"org.apache.spark.sql.parquet.row.metadata": laid.drop("cell_partition").schema.json()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)
        name, rows = f"part-{TaskContext.get().partitionId():06d}.zstd.parquet", 0
        held: list[pa.RecordBatch] = []
        out = cell = own = None

        def flush(finish: bool) -> None:
            nonlocal out, own
            if held and (finish or sum(b.num_rows for b in held) >= ROW_GROUP):
                t = pa.Table.from_batches(held)
                held.clear()
                if out is None:
                    files.create_dir(f"{root}/{_folder(cell)}", recursive=True)
                    own = f"{root}/{_folder(cell)}/_{uuid.uuid4().hex}"
                    out = pq.ParquetWriter(own, t.schema, compression="zstd", filesystem=files)
                out.write_table(t, row_group_size=ROW_GROUP)
            if finish and out is not None:
                out.close()
                files.move(own, f"{root}/{_folder(cell)}/{name}")
                out = None

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell_partition").to_pylist()
            rest = batch.drop_columns(["cell_partition"])
            rest = rest.replace_schema_metadata({**(rest.schema.metadata or {}), **footer})
            edges = [0, *(k for k in range(1, len(cells)) if cells[k] != cells[k - 1]), len(cells)]
            for a, b in zip(edges, edges[1:], strict=False):
                if cells[a] != cell:
                    flush(True)
                    cell = cells[a]
                held.append(rest.slice(a, b - a))
                flush(False)
            rows += batch.num_rows
        flush(True)
        yield pa.RecordBatch.from_pylist([{"rows": rows}], schema=pa.schema([("rows", pa.int64())]))

    laid.mapInArrow(write, "rows long").agg(F.sum("rows")).collect()


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_cells`` wrote. Spark lists each folder in a task of its own, up to 10,000; here as many tasks as a shuffle has list them."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name, None)
    spark.conf.set(name, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_cells_of(df: DataFrame, path: str, partition_degrees: float, sort_degrees: float, mode: str = "errorifexists", geometry: str = "geometry") -> None:
    """``write_cells`` by the cells of geometries' centroids; rows without a geometry are left out."""
    at = nonempty(df, geometry).withColumn("_at", spatial.st_centroid(geometry))
    x, y = F.col("_at.x"), F.col("_at.y")
    keyed = at.withColumn("_coarse", cell(x, y, partition_degrees)).withColumn("_sort", cell(x, y, sort_degrees)).drop("_at")
    write_cells(keyed, path, F.col("_coarse"), F.col("_sort"), mode)


def write_geoparquet(df: DataFrame, path: str, attribution: dict | None = None, geometry: str = "geometry", mode: str = "errorifexists") -> int:
    """ZSTD GeoParquet: each task writes one file whose footer has ``geo`` and, as JSON, ``attribution``. Returns the number of rows written.

    Spark's own writer sets no such keys. A task writes under a name of its own and then renames, so one that runs twice leaves one file."""
    spark = df.sparkSession
    if storage.exists(spark, path):
        if mode == "errorifexists":
            raise FileExistsError(path)
        storage.remove(spark, path)
    footer = {"geo": json.dumps({"version": "1.0.0", "primary_column": geometry, "columns": {geometry: {"encoding": "WKB", "geometry_types": []}}})}
    if attribution:
        footer["attribution"] = json.dumps(attribution)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)
        files.create_dir(folder, recursive=True)
        target, rows, out, held = f"{folder}/part-{TaskContext.get().partitionId():06d}.parquet", 0, None, []
        own = f"{folder}/_{uuid.uuid4().hex}"

        def flush() -> None:
            t = pa.Table.from_batches(held)
            out.write_table(t, row_group_size=ROW_GROUP)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                schema = batch.schema.with_metadata({**(batch.schema.metadata or {}), **footer})
                out = pq.ParquetWriter(own, schema, compression="zstd", filesystem=files)
            held.append(batch.replace_schema_metadata(out.schema.metadata))
            rows += batch.num_rows
            while sum(b.num_rows for b in held) >= ROW_GROUP:
                t = pa.Table.from_batches(held)
                out.write_table(t.slice(0, ROW_GROUP), row_group_size=ROW_GROUP)
                rest = t.slice(ROW_GROUP)
                held[:] = rest.to_batches()
        if out is not None:
            if held:
                flush()
            out.close()
            files.move(own, target)
        yield pa.RecordBatch.from_pylist([{"rows": rows}], schema=pa.schema([("rows", pa.int64())]))

    return int(df.mapInArrow(write, "rows long").agg(F.sum("rows")).first()[0] or 0)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, geo, attribution) of the Parquet files in a folder, from their footers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, place = arrow_fs.FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                with files.open_input_file(place) as f:
                    meta = pq.read_metadata(f)
                have = meta.metadata or {}
                yield pa.RecordBatch.from_pylist([{"file": name, "rows": meta.num_rows, "geo": (have.get(b"geo") or b"").decode(), "attribution": (have.get(b"attribution") or b"").decode()}])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select("path").mapInArrow(read, "file string, rows long, geo string, attribution string")


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of what was written; Parquet footers answer it."""
    return spark.read.parquet(path).count()
