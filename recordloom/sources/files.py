"""Readers and writers for lines, CSV, JSON, fixed-width binary and snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ------------------------------------------------------------------------ lines


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (`value`), split across tasks."""
    return spark.read.option("lineSep", "\n").text(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.option("lineSep", "\n").text(path)


def count_matching(lines: DataFrame, token: str, column: str = "value") -> DataFrame:
    """Number of lines and of lines that hold `token`, in one pass."""
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.contains(F.col(column), F.lit(token))).alias("n_matching"),
    )


# -------------------------------------------------------------------------- csv


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, columns found by name; a missing one is an error.

    A file whose header differs from the first one's is an error too. `multi_line` reads
    quoted line breaks as part of a value; files are then not split.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    wanted = {f.name: f for f in schema.fields}
    full = T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in header])
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .schema(full)
        .csv(path)
        .select(*[f.name for f in schema.fields])
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Header and values only, no index column."""
    df.write.option("header", True).option("escape", '"').csv(path)


# ------------------------------------------------------------------------- json


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line, keys in column order."""
    df.write.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Every row of a (nested) report as one JSON line."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


# --------------------------------------------------------- fixed-width records

_NUMPY = {"float": "<f4", "double": "<f8", "int": "<i4", "bigint": "<i8", "uint32": "<u4"}
_RANGE_BYTES = 16 << 20


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") else path


_MARK = "_fixed_records"  # tells a folder written by `write_fixed` from any other


def write_fixed(df: DataFrame, column: str, dtype: str, path: str) -> int:
    """Numeric arrays as packed little-endian records, one file per task; returns their number.

    Tasks write into a new folder beside the target, each attempt under its own name; once
    all are done that folder takes the target's place by one rename, so readers see all
    records or none. A target that an earlier call wrote is replaced; one that holds files
    of anybody else is an error and stays as it is.
    """
    from pyarrow import fs

    code = _NUMPY[dtype]
    uri = _uri(path) if ":" in path else f"file://{path}"
    store, folder = fs.FileSystem.from_uri(uri.rstrip("/"))
    there = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    names = {f.base_name for f in there}
    foreign = {n for n in names if n != _MARK and not n.startswith("part-")}
    if foreign or (names and _MARK not in names):
        raise FileExistsError(f"{path} holds files that this write may not replace")
    above, _, last = folder.rpartition("/")
    stage = f"{above}/_{last}-{uuid.uuid4().hex}"
    stage_uri = f"{uri.rstrip('/').rpartition('/')[0]}/{stage.rpartition('/')[2]}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        store, folder = fs.FileSystem.from_uri(stage_uri)
        store.create_dir(folder, recursive=True)
        part = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}"
        n = 0
        with store.open_output_stream(f"{folder}/{part}") as out:
            for pdf in batches:
                if len(pdf):
                    out.write(np.concatenate(pdf[column].to_list()).astype(code).tobytes())
                n += len(pdf)
        yield pd.DataFrame({"part": [part], "n": [n]})

    written = df.select(column).mapInPandas(write, "part string, n long").collect()  # a row per task
    parts = {r["part"] for r in written}
    store.create_dir(stage, recursive=True)
    for f in store.get_file_info(fs.FileSelector(stage)):
        if f.base_name not in parts:  # of an attempt that was repeated
            store.delete_file(f.path)
    with store.open_output_stream(f"{stage}/{_MARK}"):
        pass
    if store.get_file_info(folder).type != fs.FileType.NotFound:
        store.delete_dir(folder)
    store.move(stage, folder)
    return sum(r["n"] for r in written)


def read_fixed(spark: SparkSession, path: str, dtype: str, width: int) -> DataFrame:
    """Raw fixed-width files -> (path, record_no, items), read in byte ranges.

    records = values // width per file; an incomplete last record is dropped.
    """
    code = _NUMPY[dtype]
    size = np.dtype(code).itemsize * width
    span = max(1, _RANGE_BYTES // size)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    last = F.floor(F.col("length") / F.lit(size)).cast("long") - 1
    ranges = (
        files.select("path", last.alias("last"))
        .filter("last >= 0")
        .select(
            "path",
            "last",
            F.explode(F.sequence(F.lit(0).cast("long"), "last", F.lit(span).cast("long"))).alias("at"),
        )
        .repartition("path", "at")
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            for file, end, at in pdf[["path", "last", "at"]].itertuples(index=False):
                store, name = fs.FileSystem.from_uri(_uri(file))
                with store.open_input_file(name) as source:
                    source.seek(at * size)
                    data = source.read(min(span, end + 1 - at) * size)
                items = np.frombuffer(data, dtype=code).reshape(-1, width)
                yield pd.DataFrame(
                    {"path": file, "record_no": np.arange(at, at + len(items)), "items": list(items)}
                )

    item = "bigint" if dtype == "uint32" else dtype
    return ranges.mapInPandas(read, f"path string, record_no long, items array<{item}>")


# ------------------------------------------------------------------ whole texts


def write_texts(df: DataFrame, path: str) -> None:
    """(name, text) -> text files below a new `path`, one per name and task: `<name>.<task>.txt`.

    Tasks write the files themselves, so neither folders nor renames pile up on the driver, however
    many files there are. Texts of one name in one task follow each other, each with a newline.
    """
    from pyarrow import fs

    uri = _uri(path) if ":" in path else f"file://{path}"
    target, base = fs.FileSystem.from_uri(uri)
    target.create_dir(base, recursive=True)  # without rows, too

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        store, root = fs.FileSystem.from_uri(uri)
        folders, n = set(), 0
        rows = (row for pdf in batches for row in zip(pdf["name"], pdf["text"]))
        for name, texts in groupby(rows, key=lambda row: row[0]):
            file = f"{root}/{name}.{ctx.partitionId():05d}.txt"
            folder = file.rpartition("/")[0]
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            part = f"{file}.{ctx.taskAttemptId()}"  # a second attempt never cuts a finished file
            with store.open_output_stream(part) as out:
                out.write("".join(f"{text}\n" for _, text in texts).encode())
            store.move(part, file)
            n += 1
        yield pd.DataFrame({"n": [n]})

    ordered = df.select("name", "text").sortWithinPartitions("name")
    ordered.mapInPandas(write, "n long").agg(F.sum("n")).first()


# ---------------------------------------------------------------------- listing


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Base name -> full path; on equal names the greatest path wins and is counted."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )
    return (
        found.withColumn("name", F.element_at(F.split("path", "/"), -1))
        .groupBy("name")
        .agg(
            F.max("path").alias("path"),
            F.max_by("length", "path").alias("length"),
            F.count(F.lit(1)).alias("n_paths"),
        )
    )


# -------------------------------------------------------------------- snapshots


def write_version(df: DataFrame, base: str, version: str) -> None:
    """Immutable snapshot; writing an existing version fails."""
    df.write.mode("errorifexists").parquet(f"{base}/version={version}")


def read_version(
    spark: SparkSession, base: str, version: str, columns: list[str] | None = None
) -> DataFrame:
    """One explicit version, columns picked by name."""
    df = spark.read.parquet(f"{base}/version={version}")
    return df.select(*columns) if columns else df


# ----------------------------------------------------------------------- corpus


def write_corpus(tokens: DataFrame, vocab: DataFrame, meta: DataFrame, path: str) -> None:
    """Token ids (Parquet), term map (JSON lines) and one metadata object."""
    tokens.write.parquet(f"{path}/tokens")
    vocab.write.json(f"{path}/vocab")
    meta.select(F.to_json(F.struct(*meta.columns)).alias("value")).write.text(f"{path}/metadata")


def read_corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokens, vocab, metadata) of a written corpus."""
    vocab = spark.read.schema("id long, term string, n long").json(f"{path}/vocab")
    meta = spark.read.json(f"{path}/metadata")
    return spark.read.parquet(f"{path}/tokens"), vocab, meta
