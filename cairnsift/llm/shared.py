"""Small pieces that several text operators use."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# White space between words.
SPACE = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none for null, empty or blank texts."""
    for space in SPACE[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.coalesce(F.split(text, " ", -1), F.array().cast("array<string>")), "")


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# What a Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20


def shipped(spark: SparkSession) -> SparkSession:
    """Prepare a session for Python workers: batches of a bounded size, and this package where their path does not have
    it already. Only code is shipped."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root) not in on_path and not getattr(context, "_package_shipped", False):
        with tempfile.TemporaryDirectory() as folder:
            source = Path(folder, "code")
            shutil.copytree(root / "cairnsift", source / "cairnsift", ignore=shutil.ignore_patterns("__pycache__"))
            packed = shutil.make_archive(str(Path(context._temp_dir, "cairnsift_code")), "zip", source)
            context.addPyFile(packed)
        context._package_shipped = True
    return spark
