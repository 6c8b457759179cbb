"""Exchanging a finished new content for the old one, with a journal that outlives a crash.

The new content is complete before anything is touched. Then its intent is written down: a file beside a path, two
properties of the new table for a catalog table. From then on every step can be repeated, and ``recover`` goes on from
whatever step was reached:

    written | intent | old one moved aside | new one at the target | old one deleted, intent deleted

Before the intent the old content stands and the unfinished new one is nobody's; after it the new content wins. One writer at
a time may replace a target.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Stores that copy file by file where others rename a folder in one step.
COPYING_STORES = frozenset(("s3", "s3a", "s3n", "gs", "oss", "cos", "swift", "wasb", "wasbs"))
TARGET_PROPERTY, OLD_PROPERTY = "exchange.target", "exchange.old"


class PathExchange:
    """The folder ``target`` and what lies beside it."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.intent = f"{self.target}.intent"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self._path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def check_store(self) -> None:
        scheme = self.files.getUri().getScheme()
        if scheme in COPYING_STORES:
            raise ValueError(f"{scheme} cannot exchange folders in one step; replace {self.target} without atomic")

    def exists(self, name: str) -> bool:
        return self.files.exists(self._path(name))

    def _rename(self, old: str, new: str) -> None:
        if not self.files.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def _delete(self, name: str) -> None:
        self.files.delete(self._path(name), True)

    def write(self, df: DataFrame, partition_by: Sequence[str]) -> dict[str, str]:
        """The new content beside the target, and its intent, not yet written down."""
        mark = uuid.uuid4().hex
        intent = {"new": f"{self.target}.new-{mark}", "old": f"{self.target}.old-{mark}"}
        try:
            df.write.format("parquet").partitionBy(*partition_by).save(intent["new"])
        except BaseException:
            self._delete(intent["new"])
            raise
        return intent

    def announce(self, intent: dict[str, str]) -> None:
        """Writes the intent down, in one step."""
        draft = f"{self.intent}-{uuid.uuid4().hex}"
        out = self.files.create(self._path(draft))
        out.write(bytearray(json.dumps(intent).encode()))
        out.close()
        self._rename(draft, self.intent)

    def interrupted(self) -> bool:
        """Whether reading the target would not find a whole content."""
        return not self.exists(self.target)

    def announced(self) -> dict[str, str] | None:
        if not self.exists(self.intent):
            return None
        source = self.files.open(self._path(self.intent))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return json.loads(text)

    def retire(self, intent: dict[str, str]) -> None:
        """Moves the old content aside, unless that is done: then the new one is no longer beside the target."""
        if self.exists(intent["new"]) and self.exists(self.target):
            self._rename(self.target, intent["old"])

    def promote(self, intent: dict[str, str]) -> None:
        if self.exists(intent["new"]):
            self._rename(intent["new"], self.target)

    def finish(self, intent: dict[str, str]) -> None:
        """The old content goes before the intent, so none is left that nothing names."""
        self._delete(intent["old"])
        self._delete(self.intent)


class TableExchange:
    """The catalog table ``target`` and the tables beside it."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        *scope, name = target.split(".")
        self.scope, self.name = scope, name.strip("`")
        self.target = ".".join([*scope, f"`{self.name}`"])

    def check_store(self) -> None:
        """A catalog's rename moves names; whether it moves files is its own affair."""

    def _beside(self, name: str) -> str:
        return ".".join([*self.scope, f"`{name}`"])

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def _properties(self, name: str) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}

    def write(self, df: DataFrame, partition_by: Sequence[str]) -> dict[str, str]:
        mark = uuid.uuid4().hex
        new, old = (self._beside(f"{self.name}_{kind}_{mark}") for kind in ("new", "old"))
        try:
            df.write.format("parquet").partitionBy(*partition_by).saveAsTable(new)
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        return {"new": new, "old": old}

    def announce(self, intent: dict[str, str]) -> None:
        """The intent travels with the new table, so after the exchange the target has it until all is done."""
        listed = ", ".join(
            f"'{key}' = '{value}'"
            for key, value in ((TARGET_PROPERTY, json.dumps(intent)), (OLD_PROPERTY, intent["old"]))
        )
        self.spark.sql(f"ALTER TABLE {intent['new']} SET TBLPROPERTIES ({listed})")

    @property
    def _elsewhere(self) -> bool:
        """In another catalog, or in a database that is not there: no exchange of this module."""
        if len(self.scope) > 1 and self.scope[0].strip("`") != "spark_catalog":
            return True
        return bool(self.scope) and not self.spark.catalog.databaseExists(".".join(self.scope))

    def interrupted(self) -> bool:
        """Whether reading the target would not find a whole content."""
        if self._elsewhere:
            return False
        return not self.exists(self.target) or TARGET_PROPERTY in self._properties(self.target)

    def announced(self) -> dict[str, str] | None:
        if self._elsewhere:
            return None
        scope = f"IN {'.'.join(self.scope)}" if self.scope else ""
        beside = self.spark.sql(f"SHOW TABLES {scope} LIKE '{self.name.lower()}_new_*'").collect()
        names = [self._beside(r.tableName) for r in beside if not r.isTemporary]
        if self.exists(self.target):
            names.append(self.target)
        for name in names:
            found = self._properties(name).get(TARGET_PROPERTY)
            if found:
                return json.loads(found)
        return None

    def retire(self, intent: dict[str, str]) -> None:
        if self.exists(intent["new"]) and self.exists(self.target):
            self._rename(self.target, intent["old"])

    def promote(self, intent: dict[str, str]) -> None:
        if self.exists(intent["new"]):
            self._rename(intent["new"], self.target)

    def finish(self, intent: dict[str, str]) -> None:
        # A catalog may still have the partitions in the folders from before the renaming: reading would find nothing
        # there, and dropping the old table would delete what now is the new one's.
        for name in (self.target, intent["old"]):
            if self.exists(name) and any(c.isPartition for c in self.spark.catalog.listColumns(name)):
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        self.spark.sql(f"DROP TABLE IF EXISTS {intent['old']}")
        self.spark.sql(f"ALTER TABLE {self.target} UNSET TBLPROPERTIES ('{TARGET_PROPERTY}', '{OLD_PROPERTY}')")
        self.spark.catalog.refreshTable(self.target)


Exchange = PathExchange | TableExchange


def exchange_for(spark: SparkSession, target: str) -> Exchange:
    return PathExchange(spark, target) if "/" in target else TableExchange(spark, target)


def _steps(exchange: Exchange) -> list[Callable[[dict[str, str]], None]]:
    """What follows the intent; each may be repeated."""
    return [exchange.retire, exchange.promote, exchange.finish]


def recover(spark: SparkSession, target: str) -> bool:
    """Ends an exchange of ``target`` that was cut short; whether there was one."""
    exchange = exchange_for(spark, target)
    intent = exchange.announced()
    if intent is None:
        return False
    for step in _steps(exchange):
        step(intent)
    return True


def swap(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Write beside the target, then exchange the two; a write that fails leaves the old content."""
    exchange = exchange_for(df.sparkSession, target)
    exchange.check_store()
    recover(df.sparkSession, target)
    intent = exchange.write(df, list(partition_by))
    exchange.announce(intent)
    for step in _steps(exchange):
        step(intent)
