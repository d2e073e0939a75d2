"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tidepanel

#: ASCII white space of the contracts, as a Java and DuckDB pattern.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null ids count as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows with equal `keys` the one whose other columns are smallest, from left to right; without the keys.

    Nulls come first. Types without an order (maps, variants) are compared as JSON.
    So a task that runs again keeps the same row.
    """
    rest = {c: F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in keys}
    odd = {c for c, kind in df.dtypes if "map<" in kind or "variant" in kind}
    row = F.struct(*[col.alias(c) for c, col in rest.items()])
    if odd.isdisjoint(rest):
        least = F.min(row)
    else:
        least = F.min_by(row, F.struct(*[F.to_json(F.struct(col)) if c in odd else col for c, col in rest.items()]))
    name = free_name(df, "least")
    return df.groupBy(*keys).agg(least.alias(name)).select(*[F.col(name).getField(c).alias(c) for c in rest])


def hash_rate(col: str | Column, rate: float, salt: int) -> Column:
    """A repeatable choice of about `rate` of all values of `col`."""
    if rate >= 1:
        return F.lit(True)
    unit = F.pmod(F.xxhash64(F.lit(salt), col), F.lit(1 << 40)).cast("double") / float(1 << 40)
    return unit < F.lit(rate)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside reads and sends at most `rows` rows at once: for rows that are themselves of megabytes.

    Else a task holds all rows of its files, up to thousands, in the JVM and in Python.
    """
    names = ["spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in before.items():
            spark.conf.set(n, rows if int(value) <= 0 else min(rows, int(value)))
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def by_bytes(texts: Iterable[str | None], limit: int = 4 << 20) -> Iterator[list[str]]:
    """Lists of texts (null: empty) of about `limit` characters each."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text or "")
        size += len(chunk[-1]) + 16
        if size >= limit:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Functions that run there import the package's modules, whether or not the
    cluster's machines have it installed.
    """
    context = spark.sparkContext
    if getattr(context, "_tidepanel_shipped", False):
        return
    source = Path(tidepanel.__file__).resolve().parent
    # The driver serves the archive for as long as its context lives.
    bundle = Path(tempfile.mkdtemp(prefix="tidepanel-")) / "tidepanel_workers.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for module in sorted(source.rglob("*.py")):
            out.write(module, module.relative_to(source.parent))
    context.addPyFile(str(bundle))
    context._tidepanel_shipped = True
