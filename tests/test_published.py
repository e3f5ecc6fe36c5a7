"""Publishing in versions: what is published survives a write that fails in its last stage, a
switch that fails and a run that another overtakes; kept months aren't rewritten."""

import datetime as dt
import os
import re
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from farezone.config import fixture_params
from farezone.plans.inputs import TripInputs
from farezone.plans.monthly import run_monthly
from farezone.sources import published as P
from farezone.sources.readers import MART_SCHEMA, read_mart
from farezone.sources.sinks import extend_mart, publish, shared_dir, write_csv

from conftest import SF_SMALL

LAYOUT = ("metric", "year_month")


def table(spark, months, metric="Trips"):
    rows = [(dt.date(2000, m, 1) if m else None, metric, float(v)) for m, v in months.items()]
    return spark.createDataFrame(rows, "year_month date, metric string, count double")


def rows(spark, path):
    df = P.read_published(spark, path, table(spark, {}).schema)
    return sorted((r.metric, r.year_month.month if r.year_month else 0, r["count"]) for r in df.collect())


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def failing(monkeypatch, only=None):
    """Let the writing stage itself fail, behind the last shuffle, with some files written."""
    plain = P.laid_out

    def laid_out(df, partition_by, *how):
        out = plain(df, partition_by, *how)
        if only is None or only(df):
            column = out.columns[-1]
            broken = F.raise_error(F.lit("no space left")).cast(out.schema[column].dataType)
            out = out.withColumn(column, F.when(F.spark_partition_id() == 0, broken).otherwise(F.col(column)))
            if partition_by:  # not moved below the exchange: the id is that of the writing task
                assert "raise_error" in out._jdf.queryExecution().optimizedPlan().toString()
        return out

    monkeypatch.setattr(P, "laid_out", laid_out)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("since", [None, dt.date(2000, 2, 1)])
def test_a_failed_write_leaves_the_table(spark, monkeypatch, fmt, since):
    path = tempfile.mkdtemp(prefix="atomic-") + "/t"
    publish(table(spark, {1: 1, 2: 2, 3: 3}), path, LAYOUT, fmt)
    before, had = rows(spark, path), files(path)
    with monkeypatch.context() as m:
        failing(m)
        with pytest.raises(Exception, match="no space left"):
            publish(table(spark, {2: 20, 3: 30}), path, LAYOUT, fmt, since=since)
        with pytest.raises(Exception, match="no space left"):
            extend_mart(table(spark, {1: 9}, "Total Fare"), path, LAYOUT, fmt, ())
    assert rows(spark, path) == before and files(path) == had
    publish(table(spark, {2: 20}), path, LAYOUT, fmt, since=since)
    assert rows(spark, path) == ([("Trips", 1, 1.0)] if since else []) + [("Trips", 2, 20.0)]


def test_a_failed_switch_leaves_the_table(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="switch-") + "/t"
    publish(table(spark, {1: 1}), path, LAYOUT)
    with monkeypatch.context() as m:
        m.setattr(P._Files, "appear", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            publish(table(spark, {1: 2}), path, LAYOUT)
    assert rows(spark, path) == [("Trips", 1, 1.0)]
    publish(table(spark, {1: 3}), path, LAYOUT)
    assert rows(spark, path) == [("Trips", 1, 3.0)]
    # the folder of the failed run is gone, that of the version before stays for its readers
    assert len([n for n in os.listdir(path) if n.startswith("version=")]) == 2


def test_of_two_runs_at_once_one_fails(spark):
    path = tempfile.mkdtemp(prefix="race-") + "/t"
    publish(table(spark, {1: 1}), path, LAYOUT)
    with pytest.raises(P.PublishConflict):
        with P.Publication(spark, path) as late:
            late.write("", table(spark, {1: 5}), LAYOUT)
            publish(table(spark, {1: 7}), path, LAYOUT)
    assert rows(spark, path) == [("Trips", 1, 7.0)]
    assert not any(late.version in f for f in files(path))


def test_kept_months_are_not_rewritten_and_old_versions_go(spark):
    path = tempfile.mkdtemp(prefix="kept-") + "/t"
    interim = f"{shared_dir(spark)}/interim".removeprefix("file:")
    os.makedirs(interim, exist_ok=True)
    publish(table(spark, {1: 1, 2: 2, 3: 3, 4: 4}), path, LAYOUT)
    first, held = files(path), set(os.listdir(interim))
    reader = P.read_published(spark, path, table(spark, {}).schema)  # opened before the next publication
    publish(table(spark, {3: 30, 4: 40, None: 0}), path, LAYOUT, since=dt.date(2000, 3, 1))
    assert set(os.listdir(interim)) == held
    new = [f for f in files(path) if f not in first]
    assert set(first) <= set(files(path)) and len(new) == 2  # the month-less row isn't of the run's months
    assert sorted((r.year_month.month, r["count"]) for r in reader.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    publish(table(spark, {4: 41}), path, LAYOUT, since=dt.date(2000, 4, 1))
    assert rows(spark, path) == [("Trips", 1, 1.0), ("Trips", 2, 2.0), ("Trips", 3, 30.0), ("Trips", 4, 41.0)]
    publish(table(spark, {4: 42}), path, LAYOUT, since=dt.date(2000, 4, 1))
    months = [re.search("year_month=2000-(\\d\\d)", f).group(1) for f in files(path)]
    assert sorted(months) == ["01", "02", "03", "04", "04"]  # live ones, and what the version before named
    assert len(os.listdir(f"{path}/_manifest")) <= 4  # two manifests and their checksums


def test_filters_prune_folders_of_any_version(spark):
    path = tempfile.mkdtemp(prefix="prune-") + "/t"
    publish(table(spark, {m: m for m in range(1, 7)}), path, LAYOUT)
    publish(table(spark, {6: 60}), path, LAYOUT, since=dt.date(2000, 6, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df = P.read_published(spark, path, table(spark, {}).schema).where("year_month = '2000-06-01' and metric = 'Trips'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    assert "metric" in filters and "year_month" in filters and "version" in filters
    assert [r["count"] for r in df.collect()] == [60.0]
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    leaf.executeColumnar() if leaf.supportsColumnar() else leaf.execute()  # lists the files it would read
    assert leaf.metrics().apply("numFiles").value() == 1


def test_names_that_folders_escape(spark):
    path = tempfile.mkdtemp(prefix="esc-") + "/t"
    odd = ["a/b: 100% = c", "Größe {x}", " lead"]
    for i, name in enumerate(odd):
        extend_mart(table(spark, {1: i, None: 5}, name), path, LAYOUT, sort_within=())
    extend_mart(table(spark, {1: 9}, odd[0]), path, LAYOUT, sort_within=())
    assert rows(spark, path) == sorted([(odd[0], 1, 9.0), (odd[0], 0, 5.0), (odd[1], 1, 1.0), (odd[1], 0, 5.0),
                                        (odd[2], 1, 2.0), (odd[2], 0, 5.0)])


def test_empty_tables_and_changed_layouts(spark):
    path = tempfile.mkdtemp(prefix="empty-") + "/t"
    assert P.read_published(spark, path) is None
    publish(table(spark, {}), path, LAYOUT)
    assert rows(spark, path) == []
    publish(table(spark, {1: 1}), path, LAYOUT)
    with pytest.raises(ValueError, match="is published as parquet"):
        publish(table(spark, {2: 1}), path, LAYOUT, "csv", since=dt.date(2000, 2, 1))
    publish(table(spark, {}), path, LAYOUT, since=dt.date(2000, 2, 1))
    assert rows(spark, path) == [("Trips", 1, 1.0)]
    folder = write_csv(spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string"), f"{path}-flat", ["id"])
    assert folder == P.published_folder(spark, f"{path}-flat")
    assert [tuple(r) for r in P.read_published(spark, f"{path}-flat").collect()] == [("1", "a"), ("2", "b")]


TABLES = ("yellow_fare", "green_fare_melt", "hvfhv_fare", "fhv3")


def published(spark, out):
    return {"mart": sorted(map(str, read_mart(spark, f"{out}/trips_updated").collect())),
            **{t: sorted(map(str, P.read_published(spark, f"{out}/{t}").collect())) for t in TABLES}}


def test_a_failed_monthly_run_changes_no_table(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="run-")
    inputs, params = TripInputs.from_fixtures(spark, SF_SMALL), fixture_params()
    run_monthly(inputs, params, out, since=dt.date(2000, 7, 1))
    before = published(spark, out)
    assert all(before.values())
    breaks = {None: lambda df: "Z" in df.columns,  # a full run, in the mart
              dt.date(2000, 9, 1): lambda df: "avg_driver_pay" in df.columns}  # the last fare table, the mart being written
    for since, table_of in breaks.items():
        with monkeypatch.context() as m:
            failing(m, table_of)
            with pytest.raises(Exception, match="no space left"):
                run_monthly(inputs, params, out, since=since)
        assert published(spark, out) == before
    run_monthly(inputs, params, out, since=dt.date(2000, 5, 1))
    after = published(spark, out)
    assert all(set(before[t]) < set(after[t]) for t in TABLES[:3]) and set(before["mart"]) < set(after["mart"])


def test_an_incremental_run_keeps_a_mart_published_without_versions(spark):
    out, plain = tempfile.mkdtemp(prefix="plain-"), tempfile.mkdtemp(prefix="ref-")
    inputs, params = TripInputs.from_fixtures(spark, SF_SMALL), fixture_params()
    run_monthly(inputs, params, plain, since=dt.date(2000, 3, 1))
    mart = read_mart(spark, f"{plain}/trips_updated")
    mart.repartition(*LAYOUT).write.partitionBy(*LAYOUT).parquet(f"{out}/trips_updated")
    for t in ("yellow_fare", "green_fare", "hvfhv_fare"):
        stored = P.read_published(spark, f"{plain}/_store/{t}")
        stored.write.partitionBy("year_month").parquet(f"{out}/_store/{t}")
    run_monthly(inputs, params, out, since=dt.date(2000, 6, 1))
    assert published(spark, out) == published(spark, plain)
    shutil.rmtree(plain)
    assert mart.schema.fieldNames() == MART_SCHEMA.fieldNames()
