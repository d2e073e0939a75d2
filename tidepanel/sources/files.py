"""Delimited raw files whose encoding and separator vary from file to file."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidepanel import config
from tidepanel.session import materialize
from tidepanel.sources.utf16 import PATH, read_utf16

HEAD_BYTES = 65_536
# Spark's reader names of the detected encodings (the UTF-8 reader drops a BOM).
READER_CHARSET = {"utf-8-sig": "UTF-8", "utf-16": "UTF-16", "cp1252": "windows-1252"}


def build_path(data_dir: str, year: int, period: str, ext: str, kind: str = config.FILE_KIND) -> str:
    """Path of one raw file by the naming convention."""
    return f"{data_dir.rstrip('/')}/{kind}/data-{year}-{kind}/{year}-{period}-{kind}.{ext}"


def manifest(
    spark: SparkSession, data_dir: str, entries=tuple(config.FILE_MANIFEST)
) -> DataFrame:
    """(year, period, path) of every expected file."""
    rows = [(y, p, build_path(data_dir, y, p, ext)) for y, p, ext in entries]
    return spark.createDataFrame(rows, "year int, period string, path string")


def list_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Paths of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(data_dir)
    return files.select(F.regexp_replace("path", r"^[a-z0-9]+:(//[^/]*)?(?=/)", "").alias("path"))


def missing_files(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files that are absent, by path."""
    return expected.join(present.select("path").distinct(), "path", "left_anti")


def check_columns(actual: list[str], required: list[str], where: str) -> None:
    lacking = [c for c in required if c not in actual]
    if lacking:
        raise ValueError(f"{where}: missing columns {lacking}, found {list(actual)}")


def detect_formats(
    spark: SparkSession,
    paths: list[str],
    required: list[str] = config.REQUIRED_COLUMNS,
    encodings: list[str] = config.ENCODINGS,
    separators: list[str] = config.SEPARATORS,
    strict_decoding: bool = False,
) -> DataFrame:
    """(path, encoding, separator, header) of each file, NULL where no combination fits or there is no file.

    The first combination whose header holds the required columns wins, with
    encodings tried before separators. Undecodable bytes are replaced and do
    not reject an encoding, unless `strict_decoding` is set. Folders are listed
    in tasks, then the files found are dealt out anew, so the parts of one folder
    are opened by many tasks; only the first bytes of each are read. A
    path may also be a folder: each of its parts that is not empty has a row of
    its own, since parts may differ in format and order of columns.
    """
    need, encs, seps, strict, size = set(required), encodings, separators, strict_decoding, HEAD_BYTES

    def opened(path):
        import re

        from pyarrow import fs

        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def files_of(path):
            where, inner = opened(path)
            if where.get_file_info(inner).type != fs.FileType.Directory:
                return [(path, True)]
            parts = where.get_file_info(fs.FileSelector(inner))
            found = [
                (f"{path.rstrip('/')}/{p.base_name}", True) for p in parts
                if p.size and not p.base_name.startswith(("_", "."))
            ]
            return found or [(path, False)]

        for batch in batches:
            yield pd.DataFrame([f for p in batch["path"] for f in files_of(p)], columns=["path", "there"])

    def sniff(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        def head_of(path, there):
            if not there:
                return b""
            where, inner = opened(path)
            with where.open_input_stream(inner) as stream:
                return stream.read(size)

        def decode(head, enc):
            if not strict:
                return head.decode(enc, errors="replace")
            # A cut head may end inside a character: leave the last line out.
            return (head if len(head) < size else head[: head.rfind(b"\n") + 1]).decode(enc)

        def fit(head):
            for enc in encs:
                try:
                    text = decode(head, enc)
                except UnicodeError:
                    continue
                first = text.split("\n", 1)[0].rstrip("\r")
                for sep in seps:
                    header = next(csv.reader([first], delimiter=sep), [])
                    if need.issubset(header):
                        return enc, sep, header
            return None, None, None

        for batch in batches:
            found = [(p, *fit(head_of(p, there))) for p, there in zip(batch["path"], batch["there"])]
            yield pd.DataFrame(found, columns=["path", "encoding", "separator", "header"])

    # Opening files is latency, not data: some per task.
    tasks = 4 * spark.sparkContext.defaultParallelism
    named = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), tasks)))
    found = named.mapInPandas(listed, "path string, there boolean").repartition(tasks)
    return found.mapInPandas(
        sniff, "path string, encoding string, separator string, header array<string>"
    )


def require_formats(formats: DataFrame) -> list:
    """The distinct formats with the paths of their files; a file without one is an error."""
    formats = materialize(formats, "formats")
    unknown = [r["path"] for r in formats.filter(F.col("encoding").isNull()).select("path").limit(100).collect()]
    if unknown:
        raise ValueError(f"no valid format for: {sorted(unknown)}")
    alike = formats.groupBy("encoding", "separator", "header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return sorted(alike.collect(), key=lambda r: r["paths"])


def read_files(
    spark: SparkSession,
    paths: list[str],
    encoding: str,
    separator: str,
    required: list[str] = config.REQUIRED_COLUMNS,
    header: list[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Text columns of files that share one format and one header.

    Undecodable bytes are replaced, not fatal. With a known `header` nothing is
    inferred, and a file with another header is an error; then UTF-16 files too
    are read in ranges of bytes, and have a column `path`. `multi_line` allows line ends in
    quoted cells, and one task streams each file.
    """
    if encoding == "utf-16" and header is not None and not multi_line:
        check_columns(header, required, str(paths))
        return read_utf16(spark, paths, separator, header)
    reader = spark.read.option("header", True).option("sep", separator).option(
        "encoding", READER_CHARSET[encoding]
    )
    if encoding == "utf-16" or multi_line:
        reader = reader.option("multiLine", True)
    if header is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        reader = reader.option("enforceSchema", False)
    df = reader.csv(paths)
    check_columns(df.columns, required, str(paths))
    return df


def load_source(
    spark: SparkSession, formats: list, required: list[str] = config.REQUIRED_COLUMNS, multi_line: bool = False
) -> list[DataFrame]:
    """One frame per distinct format and header, with ANNEE and PERIODE from the paths.

    The id column changes name by year, so headers differ; `concat_facts`
    unites the frames under one name. Thousands of files still make only a
    handful of scans.
    """
    # The file itself or, for a folder of parts, its folder carries the name.
    pattern = r"(\d{4})-([A-Z]\d+)-[^/]*(?:/[^/]*)?$"
    frames = []
    for row in formats:
        df = read_files(spark, row["paths"], row["encoding"], row["separator"], required, row["header"], multi_line)
        source = F.col(PATH if PATH in df.columns and PATH not in row["header"] else "_metadata.file_path")
        frames.append(
            df.select(
                *row["header"],
                F.regexp_extract(source, pattern, 1).alias("ANNEE"),
                F.regexp_extract(source, pattern, 2).alias("PERIODE"),
            )
        )
    return frames
