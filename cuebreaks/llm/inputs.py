"""What the operators share: reading tables, the text class of white space, row identity."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cuebreaks

SPACE_RUN = r"[\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which may not have it on their own path."""
    context, package = spark.sparkContext, Path(cuebreaks.__file__).parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="cuebreaks-")) / "cuebreaks.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_hash(column: str = "text") -> Column:
    """Tells rows that share a ``doc_id`` apart; rows alike in both have equal results anyway."""
    return F.xxhash64(F.col(column).isNull(), F.col(column))


def same(left: str, right: str) -> Column:
    """Equality for join keys under which NULL equals NULL."""
    return F.col(left).eqNullSafe(F.col(right))
