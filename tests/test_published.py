"""Tables replaced by one commit, landings in two hops, and runs that continue."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecost import sources
from sparecost.plans import archive, interim, quarter
from sparecost.session import Stages, stage_end
from sparecost.sources import Published, PublishConflict


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_refresh_reads_its_own_target(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    assert sources.full_refresh(spark.range(5), table) == 5
    old = table.read()
    assert sources.full_refresh(table.read().withColumn("id", F.col("id") + 1).filter("id > 2"), table) == 3
    assert rows(old) == [(i,) for i in range(5)] and rows(table.read()) == [(3,), (4,), (5,)]


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.refresh(spark.range(3))
    with pytest.raises(Exception, match="broken"):
        table.refresh(spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")))))
    assert rows(table.read()) == [(0,), (1,), (2,)] and len(table.commit_numbers()) == 1


def test_drop_keeps_readers_and_vacuum_ends_them(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.refresh(spark.range(2))
    old = table.read()
    table.drop()
    with pytest.raises(ValueError, match="no such table"):
        table.read()
    table.refresh(spark.range(4).withColumnRenamed("id", "other"))
    assert old.count() == 2 and table.read().columns == ["other"]
    assert len(table.vacuum(keep=1)) == 1 and table.read().count() == 4 and len(table.commit_numbers()) == 1


def test_the_second_of_two_writers_fails(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.refresh(spark.range(2))
    before = table.current()
    table.refresh(spark.range(3))
    with pytest.raises(PublishConflict):
        table._publish(before, before)
    assert table.read().count() == 3


def parts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v int, p string")


def test_replace_changes_its_values_only(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "p")
    assert table.refresh(parts(spark, (1, "a"), (2, "b=/ 1"), (3, "c"))) == 3
    assert table.replace(parts(spark, (9, "b=/ 1")), ["b=/ 1", "c", "d"]) == 1
    assert rows(table.read()) == [(1, "a"), (9, "b=/ 1")]
    with pytest.raises(Exception, match="not among the replaced values"):
        table.replace(parts(spark, (5, "a")), ["c"])
    with pytest.raises(Exception, match="not among the replaced values"):
        table.replace(parts(spark, (5, None)), ["c"])
    assert rows(table.read(1)) == [(1, "a"), (2, "b=/ 1"), (3, "c")]
    assert table.replace(parts(spark, (0, "")).limit(0), ["a", "b=/ 1"]) == 0 and table.read().columns == ["v", "p"] and table.read().count() == 0


def test_a_load_is_one_pass(spark, tmp_path):
    """The rows are counted while they are written: the source is read by one job, and one more serves the split of files."""
    source = spark.range(1000).withColumn("data_period", F.lit("x"))
    table = Published(spark, str(tmp_path / "t"), "data_period")
    plain = jobs_of(spark, "plain", lambda: source.hint("rebalance").write.parquet(str(tmp_path / "plain")))
    assert jobs_of(spark, "published", lambda: table.replace(source, ["x"])) == plain
    path = str(tmp_path / "period")
    assert jobs_of(spark, "period", lambda: sources.overwrite_period(source, path, "2017Q1")) == plain
    assert sources.overwrite_period(source.limit(7), path, "2017Q1") == 7


def test_a_window_that_fails_between_two_days_stays(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "day")
    days = spark.sql("SELECT id AS v, timestampadd(DAY, CAST(id AS INT), TIMESTAMP '2024-01-05 10:00:00') AS at FROM range(9)")
    sources.full_refresh(days.withColumn("day", F.to_date("at").cast("string")), table)
    old = rows(table.read())
    bad = days.withColumn("v", F.when(F.to_date("at") < "2024-01-09", F.col("v") * 10).otherwise(F.raise_error(F.lit("source lost"))))
    with pytest.raises(Exception, match="source lost"):
        sources.reload_window(bad, table, "at", "2024-01-06", "2024-01-12")
    assert rows(table.read()) == old
    new = days.withColumn("v", F.col("v") * 10).filter("v <> 20")
    assert sources.reload_window(new.union(new), table, "at", "2024-01-06", "2024-01-12") == 6
    assert sorted(r["v"] for r in table.read().collect()) == [0, 8, 10, 30, 40, 50, 60, 70]


def test_landing_takes_new_late_and_changed_months(spark, tmp_path):
    zone, target = Published(spark, str(tmp_path / "zone"), "p"), Published(spark, str(tmp_path / "target"), "p")
    sources.land(parts(spark, (1, "201510"), (2, "201511"), (3, "201601"), (4, None)), zone)
    assert sources.advance(zone, target, "201511") == ["201511", "201601"]
    before = target.current().number
    assert sources.advance(zone, target, "201511") == [] and target.current().number == before
    sources.land(parts(spark, (1, "201510"), (2, "201511"), (5, "201511"), (6, "201512"), (3, "201601")), zone)
    assert sources.advance(zone, target, "201511") == ["201511", "201512"]
    sources.land(parts(spark, (2, "201511"), (5, "201511"), (6, "201512")), zone)
    assert sources.advance(zone, target, "201511") == ["201601"]
    assert rows(target.read()) == [(2, "201511"), (5, "201511"), (6, "201512")]


def test_history_of_two_layouts(spark, tmp_path):
    lines = spark.range(3).select(*[F.lit(None).cast("string").alias(c) if c not in ("taxes", "part_age", "region") else
                                    {"taxes": F.lit(1.25).cast("decimal(19,4)"), "part_age": F.lit(0.1).cast("double"), "region": F.lit("APJ")}[c].alias(c)
                                    for c in archive.ARCHIVE_COLUMNS])
    history = Published(spark, str(tmp_path / "h"), "data_period")
    archive.archive_period(lines, history, "2016Q4", ("taxes", "part_age"))
    archive.archive_period(lines, history, "2017Q1")
    archive.archive_period(lines.limit(2), history, "2017Q1")
    found = archive.read_history(history)
    assert dict(found.dtypes)["taxes"] == "decimal(19,4)" and dict(found.dtypes)["part_age"] == "double"
    assert {(r["data_period"], float(r["taxes"]), r["part_age"]) for r in found.collect()} == {("2016Q4", 1.25, 0.1), ("2017Q1", 1.25, 0.1)}
    assert found.filter("data_period = '2017Q1'").count() == 2
    archive.archive_period(lines.withColumn("taxes", F.lit("n/a")), history, "2016Q3")
    with pytest.raises(Exception, match="taxes: value does not fit"):
        archive.read_history(history, T.StructType([T.StructField("taxes", T.DecimalType(19, 4)), T.StructField("data_period", T.StringType())])).collect()


def test_a_label_is_replaced_beside_others(spark, tmp_path):
    schema = ("unique_link_key string, region string, part_number string, warranty_flag string, dmr_status string, part_qty_consumed int, "
              "part_qty_demanded int, event_pn_nrs double, event_spl string, cons_cost double, nppo_cost double, relabel_cost double, "
              "dekit_cost double, taxes double, total_matl_cost double, data_period string")

    def line(key, period, cost):
        return (key, "APJ", "P1", "IW", "No DMR", 2, 2, 4.0, "07", 3.0, None, 1.0, 0.0, 0.0, cost, period)

    history = spark.createDataFrame([line("a", "2016Q4", 10.0), line("b", "2017Q1", 12.0), line("c", "2017Q2", 5.0)], schema)
    table = Published(spark, str(tmp_path / "t"), "interim_period")
    for period in ("2017Q1", "2017Q2", "2017Q1"):
        assert interim.publish_interim(history, None, period, table) == 1
    assert [(r["interim_period"], r["unique_link_key"], float(r["interim_total"])) for r in table.read().orderBy("interim_period").collect()] == [
        ("2016Q4-2017Q1", "b", 20.0), ("2017Q1-2017Q2", "c", 24.0)]


def test_a_stopped_run_continues(spark):
    """Three steps, stopped after the second: the next run builds the third only; another basis starts anew."""
    built = []

    def run(stages, broken=False):
        df = stages.end("one", lambda: built.append("one") or spark.range(10))
        df = stages.end("two", lambda: built.append("two") or df.filter("id > 3"))
        if broken:
            raise RuntimeError("lost")
        return stages.end("three", lambda: built.append("three") or df.filter("id > 6")).count()

    with pytest.raises(RuntimeError, match="lost"):
        with Stages(spark, "resume", "a") as stages:
            run(stages, broken=True)
    with Stages(spark, "resume", "a") as stages:
        assert run(stages) == 3 and stages.resumed == ["one", "two"] and built == ["one", "two", "three"]
    with Stages(spark, "resume", "a") as stages:
        assert run(stages) == 3 and stages.resumed == []
    with pytest.raises(RuntimeError):
        with Stages(spark, "resume", "a") as stages:
            run(stages, broken=True)
    with Stages(spark, "resume", "b") as stages:
        assert run(stages) == 3 and stages.resumed == []


def test_a_quarter_continues_behind_its_last_cut(spark, monkeypatch):
    """Stopped after the second cut of five, the run plans and writes the last three only."""
    done = []
    monkeypatch.setattr(quarter, "linked", lambda df, *a: df)
    for name in ("based", "classified", "costed", "charged", "credited"):
        monkeypatch.setattr(quarter, name, lambda *a, name=name: done.append(name) or spark.range(3))
    monkeypatch.setattr(quarter, "totalled", lambda df, *a: df.withColumn("tag_key", F.lit(1)))
    costed = quarter.costed
    monkeypatch.setattr(quarter, "costed", lambda *a: 1 / 0)
    inputs = {"service_events": spark.range(1)}
    args = (inputs, quarter.R.Period(), quarter.R.Options())
    with pytest.raises(ZeroDivisionError):
        with Stages(spark, "2017Q1", quarter.basis(*args)) as stages:
            quarter.run_quarter(*args, stages=stages)
    assert done == ["based", "classified"]
    monkeypatch.setattr(quarter, "costed", costed)
    with Stages(spark, "2017Q1", quarter.basis(*args)) as stages:
        assert quarter.run_quarter(*args, stages=stages).count() == 3 and stages.resumed == ["base", "classified"]
    assert done == ["based", "classified", "costed", "charged", "credited"]


def test_rows_of_few_values_are_written_without_a_shuffle(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "p")
    rows_of_two = parts(spark, (1, "a"), (2, "b"), (2, "b"), (4, "b")).repartition(2, "v")
    assert jobs_of(spark, "unspread", lambda: table.refresh(rows_of_two, spread=False)) < jobs_of(spark, "spread", lambda: table.refresh(rows_of_two))
    assert rows(table.read()) == rows(table.read(1)) == [(1, "a"), (2, "b"), (2, "b"), (4, "b")]
    assert table.replace(parts(spark, (3, "b"), (5, "b")), ["b"], spread=False) == 2
    assert rows(table.read()) == [(1, "a"), (3, "b"), (5, "b")]


def test_the_estimate_reads_no_more_than_it_says(spark):
    numbers = ("part_qty_consumed", "part_qty_demanded", "event_pn_nrs", "cons_cost", "nppo_cost", "relabel_cost", "dekit_cost", "taxes", "total_matl_cost")
    schema = ", ".join(f"{c} {'double' if c in numbers else 'string'}" for c in interim.READS)
    history = spark.createDataFrame([tuple({"data_period": p}.get(c, 1.0 if c in numbers else "x") for c in interim.READS) for p in ("2016Q4", "2017Q1")], schema)
    adders = spark.createDataFrame([("x", "x", 2.0, "2017Q1")], "region string, event_spl string, non_nrs_rate double, data_period string")
    assert [r["interim_option"] for r in interim.interim_costs(history, adders, "2017Q1").collect()] == ["Option 1 - PART CONS"]


def test_a_period_is_archived_without_a_shuffle(spark, tmp_path):
    lines = spark.range(4).repartition(2).select(*[F.col("id").cast("string").alias(c) for c in archive.ARCHIVE_COLUMNS])
    history = Published(spark, str(tmp_path / "t"), "data_period")
    spread = jobs_of(spark, "replaced", lambda: history.replace(lines.withColumn("data_period", F.lit("x")), ["x"]))
    assert jobs_of(spark, "archived", lambda: archive.archive_period(lines, history, "2017Q1")) < spread
    assert history.read().count() == 8


def test_shuffle_files_go_with_the_stage_that_made_them(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    stored = stage_end(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and stored.count() == 7


def test_a_cut_goes_once_the_next_one_is_finished(spark):
    """Its files go and its mark stays: a later run continues behind it."""
    def run(stages):
        df = stages.end("first", lambda: spark.range(10))
        return stages.end("second", lambda: df.filter("id > 3"), instead_of="first")

    with pytest.raises(RuntimeError):
        with Stages(spark, "replaced", "a") as stages:
            assert run(stages).count() == 6
            assert [s.getPath().getName() for s in stages._fs().listStatus(stages._at("first"))] == ["_SUCCESS"]
            raise RuntimeError("lost")
    with Stages(spark, "replaced", "a") as stages:
        assert run(stages).count() == 6 and stages.resumed == ["first", "second"]


def test_a_cut_within_a_stage_goes_with_it(spark):
    with Stages(spark, "within", "a") as stages:
        names = lambda: sorted(s.getPath().getName() for s in stages._fs().listStatus(stages._at(".")))
        done = stages.end("one", lambda: stages.cut(stages.cut(spark.range(10)).filter("id > 1")).filter("id > 3"))
        assert done.count() == 6 and names() == ["one"]
