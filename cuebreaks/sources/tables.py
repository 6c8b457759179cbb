"""Reading inputs and replacing the target."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from cuebreaks.sources.exchange import exchange_for, recover, swap


def is_path(table: str) -> bool:
    return "/" in table


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table by its (one- to three-part) name, or Parquet files by their path.

    If an exchange of the target was cut short and left it incomplete or away, that is ended first.
    """
    if exchange_for(spark, table).interrupted():
        recover(spark, table)
    return spark.read.parquet(table) if is_path(table) else spark.table(table)


def _written_alike(table: str) -> str:
    return table.rstrip("/") if is_path(table) else table.replace("`", "").lower()


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, by Hadoop's rules for paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def locations(spark: SparkSession, table: str) -> set[str]:
    """The folders that a table, path or view reads; none if it does not exist."""
    if is_path(table):
        return {_qualified(spark, table)}
    if not spark.catalog.tableExists(table):
        return set()
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    details = {r.col_name: r.data_type for r in described}
    if details.get("Location") and details.get("Type") != "VIEW":
        return {_qualified(spark, details["Location"])}
    analysed = spark.table(table)._jdf.queryExecution().analyzed()
    return {_qualified(spark, f) for plan in _plans(analysed) for f in _folders(plan)}


def _listed(found: JavaObject) -> Iterator[JavaObject]:
    """The members of a Scala sequence."""
    return (found.apply(k) for k in range(found.size()))


def _plans(root: JavaObject) -> Iterator[JavaObject]:
    """All nodes of an analysed plan, those of subqueries too."""
    todo = [root]
    while todo:
        plan = todo.pop()
        yield plan
        todo.extend(_listed(plan.children()))
        todo.extend(_listed(plan.subqueries()))


def _folders(plan: JavaObject) -> list[str]:
    """The folders of a file relation as the catalog or the reader named them; no file is listed."""
    kind = plan.getClass().getSimpleName()
    if kind == "HiveTableRelation":
        return [plan.tableMeta().location().toString()]
    if kind == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation":
        return [path.toString() for path in _listed(plan.relation().location().rootPaths())]
    return []


def check_target(spark: SparkSession, target: str, sources: Iterable[str]) -> None:
    """Refuse a target that is also a source: overwriting would delete what is yet to be read.

    Names are resolved to folders, also through views; a folder within another one counts as the same.
    """
    own = locations(spark, target)
    for source in sources:
        clash = _written_alike(source) == _written_alike(target) or any(
            f"{a}/".startswith(f"{b}/") or f"{b}/".startswith(f"{a}/")
            for a in own
            for b in locations(spark, source)
        )
        if clash:
            raise ValueError(f"{target} is also read by the query that would replace it")


def replace_table(
    df: DataFrame,
    target: str,
    sources: Iterable[str] = (),
    partition_by: Iterable[str] = (),
    atomic: bool = False,
) -> None:
    """Write ``df`` as the whole new content of ``target``, a table name or a path.

    ``sources`` are the tables ``df`` reads. With ``atomic`` the new content is complete before the old one
    goes: by one create-or-replace step in a catalog that has it (three-part names of other catalogs),
    otherwise by writing beside the target and exchanging the two. An exchange that was cut short is
    ended by the next ``replace_table``, or by ``read_table`` if the target is incomplete.
    """
    check_target(df.sparkSession, target, sources)
    partition_by = list(partition_by)
    if atomic and target.count(".") == 2 and not target.startswith("spark_catalog."):
        writer = df.writeTo(target)
        if partition_by:
            writer = writer.partitionedBy(*[df[c] for c in partition_by])
        return writer.createOrReplace()
    if atomic:
        return swap(df, target, partition_by)
    recover(df.sparkSession, target)  # else what an exchange left behind would win later
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
