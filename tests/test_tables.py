"""Staging, reading and replacing tables."""

import datetime as dt
import importlib
import os

import pytest
from pyspark.sql import functions as F

from cuebreaks import build_summary_table
from cuebreaks.sources import Stage, exchange, read_table, recover, release_staged, replace_table, shared_dir
from cuebreaks.sources.derived import cue_inputs
from cuebreaks.sources.tables import locations
from helpers import SMALL, bag


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stage_round_trip_and_release(spark):
    stage = Stage(spark)
    frame = spark.range(10).withColumn("at", F.lit("9999-12-31 23:59:59").cast("timestamp_ntz"))
    staged = stage.write(frame, "numbers")
    assert shared_dir(spark) in staged.inputFiles()[0]
    assert bag(staged) == bag(frame)
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    stage.release()
    assert not os.path.exists(path.removeprefix("file:")) and not os.path.exists(stage.root)
    stage.release()


def test_one_staged_relation_is_dropped(spark):
    stage = Stage(spark)
    first, second = (stage.write(spark.range(n), "numbers") for n in (3, 4))
    stage.drop(first)
    assert [os.path.exists(path) for path, _ in stage._written] == [False, True]
    assert stage.write(spark.range(5), "numbers").count() == 5 and second.count() == 4
    stage.release()


STEPS = ["announce", "retire", "promote", "finish"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("at", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize(
    "kind, existed, partition_by",
    [("path", True, []), ("path", False, ["day"]), ("table", True, ["day"]), ("table", False, [])],
)
def test_exchange_cut_short_is_ended(spark, tmp_path, monkeypatch, kind, at, when, existed, partition_by):
    target = str(tmp_path / "t") if kind == "path" else f"cut_{at}_{when}_{existed}_{len(partition_by)}"
    place = exchange.PathExchange if kind == "path" else exchange.TableExchange
    rows = lambda n: spark.range(n).withColumn("day", F.col("id") % 2)
    if existed:
        replace_table(rows(5), target)
    step = getattr(place, at)

    def stopping(self, intent):
        if when == "after":
            step(self, intent)
        raise Stopped

    with monkeypatch.context() as cut:
        cut.setattr(place, at, stopping)
        with pytest.raises(Stopped):
            replace_table(rows(3), target, atomic=True, partition_by=partition_by)
    begun = (at, when) != ("announce", "before")
    if begun or existed:
        seen = read_table(spark, target).count()
        retired = (at, when) not in (("announce", "before"), ("announce", "after"), ("retire", "before"))
        assert seen == (3 if retired or not existed else 5)
    assert recover(spark, target) in (begun, False)
    assert not recover(spark, target)
    if begun or existed:
        spark.catalog.refreshTable(target) if kind == "table" else None
        assert read_table(spark, target).count() == (3 if begun else 5)
    replace_table(rows(2), target, atomic=True, partition_by=partition_by)
    assert read_table(spark, target).count() == 2
    if begun:  # nothing is left beside the target
        if kind == "path":
            assert os.listdir(tmp_path) == ["t"]
        else:
            assert spark.sql(f"SHOW TABLES LIKE '{target.lower()}*'").count() == 1


def test_stopped_twice(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    replace_table(spark.range(5), target)
    for at in ("promote", "finish", "finish"):
        with monkeypatch.context() as cut:
            cut.setattr(exchange.PathExchange, at, lambda self, intent: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                replace_table(spark.range(7), target, atomic=True)
    assert recover(spark, target) and read_table(spark, target).count() == 7
    assert os.listdir(tmp_path) == ["t"]


def test_plain_replace_ends_an_exchange_first(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    with monkeypatch.context() as cut:
        cut.setattr(exchange.PathExchange, "promote", lambda self, intent: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replace_table(spark.range(7), target, atomic=True)
    replace_table(spark.range(2), target)
    assert read_table(spark, target).count() == 2 and not recover(spark, target)


def test_stores_without_rename_are_refused(spark, monkeypatch):
    class Uri:
        def getScheme(self):
            return "s3a"

    class Files:
        def getUri(self):
            return Uri()

    place = exchange.PathExchange(spark, "/tmp/any")
    place.files = Files()
    with pytest.raises(ValueError, match="atomic"):
        place.check_store()


def test_view_is_followed_to_its_folders_without_listing_files(spark, monkeypatch):
    for name in ("seen_a", "seen_b", "seen_c"):
        replace_table(spark.range(3), name)
    spark.sql(
        "CREATE OR REPLACE VIEW seen_view AS WITH a AS (SELECT * FROM seen_a WHERE id IN (SELECT id FROM seen_b)) "
        "SELECT a.id, (SELECT max(id) FROM seen_c) AS m FROM a"
    )
    spark.sql("CREATE OR REPLACE VIEW seen_outer AS SELECT * FROM seen_view WHERE 1 = 0")
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", lambda self: 1 / 0)
    found = locations(spark, "seen_outer")
    assert sorted(f.rsplit("/", 1)[1] for f in found) == ["seen_a", "seen_b", "seen_c"]
    for name in ("seen_a", "seen_b", "seen_c"):
        with pytest.raises(ValueError, match="replace"):
            replace_table(spark.range(1), name, sources=["seen_outer"])


@pytest.mark.parametrize("target", ["summary_target", "path"])
def test_replace_drops_the_old_content(spark, tmp_path, target):
    if target == "path":
        target = str(tmp_path / "target")
    replace_table(spark.range(5), target)
    replace_table(spark.range(3).withColumn("new", F.lit(1)), target)
    result = read_table(spark, target)
    assert result.columns == ["id", "new"] and result.count() == 3


def test_target_among_the_sources_is_refused(spark):
    with pytest.raises(ValueError, match="replace"):
        replace_table(spark.range(1), "db.Some_Table", sources=["`db`.`some_table`"])
    with pytest.raises(ValueError, match="replace"):
        replace_table(spark.range(1), "/data/x", sources=["/data/x/"])


@pytest.mark.parametrize("target", ["own_t", "default.own_t", "spark_catalog.default.own_t", "`default`.OWN_T"])
@pytest.mark.parametrize("source", ["own_t", "default.own_t", "spark_catalog.default.own_t", "own_view", "temp_view"])
def test_a_table_is_known_by_all_its_names(spark, target, source):
    if not spark.catalog.tableExists("own_t"):
        replace_table(spark.range(3), "own_t")
        spark.sql("CREATE OR REPLACE VIEW own_view AS SELECT id + 1 AS id FROM own_t")
    spark.table("own_t").createOrReplaceTempView("temp_view")
    with pytest.raises(ValueError, match="replace"):
        replace_table(spark.range(1), target, sources=[source])
    assert spark.table("own_t").count() == 3


def test_a_path_is_known_by_all_its_forms(spark, tmp_path):
    inner = tmp_path / "a" / "b"
    replace_table(spark.range(3), str(inner))
    for target in (f"file:{inner}", f"file://{inner}/", str(tmp_path / "a"), str(inner / "c")):
        with pytest.raises(ValueError, match="replace"):
            replace_table(spark.range(1), target, sources=[str(inner)])
    replace_table(spark.range(1), str(tmp_path / "a" / "bc"), sources=[str(inner)])


@pytest.mark.parametrize("target", ["swap_target", "default.swap_target2", "path"])
def test_atomic_replace_keeps_the_old_content_if_the_write_fails(spark, tmp_path, target):
    target = str(tmp_path / "swapped") if target == "path" else target
    replace_table(spark.range(5), target, atomic=True)
    failing = spark.range(4).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        replace_table(failing, target, atomic=True)
    assert read_table(spark, target).count() == 5
    replace_table(spark.range(2).withColumn("new", F.lit(1)), target, atomic=True, partition_by=["new"])
    spark.catalog.refreshTable(target) if "/" not in target else None
    assert sorted(read_table(spark, target).columns) == ["id", "new"]
    assert read_table(spark, target).count() == 2


def test_nothing_staged_is_left(spark, tmp_path, monkeypatch):
    from cuebreaks.sources import staging

    def staged_rows():
        root = f"{shared_dir(spark)}/cuebreaks-stage"
        return [s for s in staging._OPEN if s._written and s.root.startswith(root)]

    release_staged(spark)
    paths = [str(tmp_path / n) for n in ("c", "o", "m")]
    for frame, path in zip(cue_inputs(spark, SMALL), paths):
        replace_table(frame, path)
    build_summary_table(spark, *paths, str(tmp_path / "out"), run_date=dt.date(2024, 1, 2))
    assert not staged_rows()

    plan_of = importlib.import_module("cuebreaks.plans.cue_summary")

    def failing(*args):
        raise OSError("full")

    monkeypatch.setattr(plan_of, "replace_table", failing)
    with pytest.raises(OSError):
        build_summary_table(spark, *paths, str(tmp_path / "out2"), run_date=dt.date(2024, 1, 2))
    assert not staged_rows()

    plan_of.cue_summary(*cue_inputs(spark, SMALL), "exact", dt.date(2024, 1, 2))
    assert staged_rows()
    release_staged(spark)
    assert not staged_rows() and cue_inputs(spark, SMALL).cues.count() > 0


def test_partitioned_target(spark, tmp_path):
    target = str(tmp_path / "by_day")
    frame = spark.range(4).withColumn("day", F.lit(dt.date(2024, 1, 1)))
    replace_table(frame, target, partition_by=["day"])
    assert "day=2024-01-01" in read_table(spark, target).inputFiles()[0]


def test_whole_job_from_tables_to_table(spark, tmp_path):
    inputs = cue_inputs(spark, SMALL)
    names = ["job_cues", "job_corrections", "job_metadata"]
    for name, frame in zip(names, inputs):
        replace_table(frame, name)
    build_summary_table(
        spark, *names, "job_summary", "normalized", dt.date(2024, 1, 2), ("updated_date",)
    )
    result = read_table(spark, "job_summary")
    assert result.count() == 5389
    assert result.select("updated_date").distinct().first()[0] == dt.date(2024, 1, 1)
    with pytest.raises(ValueError, match="replace"):
        build_summary_table(spark, *names, "job_cues")
