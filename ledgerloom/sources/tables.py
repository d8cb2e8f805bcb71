"""Sources and sinks: tables, CSV with provenance, file listings, appends, overwrites, clustered layouts, resumable loads, moves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shaping import sample_n


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_csv(spark: SparkSession, paths: str | list[str], schema: str | T.StructType | None = None) -> DataFrame:
    """Headed CSV files whose fields may hold quotes and line feeds, with source_file, as_of_date (from the path) and ingested_at."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(paths)
    path = F.col("_metadata.file_path")
    return df.withColumns({"source_file": path, "as_of_date": F.try_to_date(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"), "ingested_at": F.current_timestamp()})


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime) of files that aren't empty; contents aren't read, as only these columns are."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    return reader.load(folder).select("path", "length", "modificationTime")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files' columns have grown over appends."""
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None) -> None:
    """Overwrite with files of disjoint ranges, rows sorted inside, so that row-group statistics prune on `by`."""
    parts = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    parts.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def resumable(spark: SparkSession, source: str, schema: T.StructType | str, checkpoint: str, step: Callable[[DataFrame, int], None], files_per_batch: int = 20) -> None:
    """Feed files that weren't fed yet to step(batch, number), in batches; a run that broke off goes on where it stopped."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def move_files(spark: SparkSession, source: str, target: str, n: int, seed: int = 7, overwrite: bool = False, retries: int = 3) -> DataFrame:
    """Move n files, chosen by a seeded hash of their paths, to target through the file system of their paths.

    Each file's size is compared after the move; (path, target, length, moved, error) for each. Runs on executors.
    """
    chosen = sample_n(list_files(spark, source), n, seed, "path").select("path", "length")

    def run(frames):
        import os
        import shutil
        import time
        from urllib.parse import unquote, urlparse

        local = lambda p: unquote(urlparse(p).path) if "://" in p or p.startswith("file:") else p
        for pdf in frames:
            out = []
            for path, length in zip(pdf["path"], pdf["length"]):
                to, error = os.path.join(local(target), os.path.basename(local(path))), ""
                for k in range(retries):
                    try:
                        if os.path.exists(to) and not overwrite:
                            raise FileExistsError(to)
                        os.makedirs(local(target), exist_ok=True)
                        shutil.copyfile(local(path), f"{to}.part")
                        if os.path.getsize(f"{to}.part") != length:
                            raise OSError(f"size differs: {to}")
                        os.replace(f"{to}.part", to)
                        os.remove(local(path))
                        error = ""
                        break
                    except FileExistsError as e:
                        error = repr(e)
                        break
                    except OSError as e:
                        error = repr(e)
                        time.sleep(0.1 * 2**k)
                out.append((path, to, length, not error, error))
            import pandas as pd

            yield pd.DataFrame(out, columns=["path", "target", "length", "moved", "error"])

    kinds = "path string, target string, length long, moved boolean, error string"
    done = chosen.mapInPandas(run, kinds).toPandas()  # n rows, and the moves happen once
    return spark.createDataFrame(done, kinds)
