"""Running Arrow batches of texts through functions of this package.

Every operator here names the columns it reads, so further columns of a table, whatever
their names, never reach it. A null text is handed on as ``None``.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in capital or small letters."""
    taken = {c.lower() for c in df.columns}
    return next(name for i in range(len(taken) + 1) if (name := f"{stem}{i}") not in taken)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 of each text; nulls stay ``None``."""
    large = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def chunks(texts: list[bytes | None], size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive runs of texts of about ``size`` bytes each, with the place of the first.

    A text is never cut, so one longer than ``size`` makes a run of its own.
    """
    start, run, held = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if run and held + len(text) > size:
            yield start, run
            start, run, held = i, [], 0
        run.append(text)
        held += len(text) + 1
    if run:
        yield start, run
