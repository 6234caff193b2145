import dataclasses
import os
import subprocess
import sys

import pytest
from py4j.protocol import Py4JJavaError

from clusterloom import JobConfig, run_job
from clusterloom.config import FOOD_BOUNDS
from clusterloom.sinks.jdbc import write_jdbc
from clusterloom.plans import job
from clusterloom.plans.job import published_run, scoring_path, stage_keys
from clusterloom.sinks.model import current_version, load_kmeans, load_scoring_model
from clusterloom.sources.jdbc import read_jdbc, table_row_count
from clusterloom.storage import persisted, snapshot, work_dir
from tests.conftest import SMALL
from tests.fixtures import FEATURES, seed_frame


def config(jdbc_table, tmp_path, **changes):
    settings = {
        "source": jdbc_table,
        "target": jdbc_table.named(jdbc_table.table + "_result"),
        "model_path": str(tmp_path / "kmeans"),
        "seed_path": None,
        "connect_attempts": 1,
    }
    return JobConfig(**{**settings, **changes})


def test_job_on_the_seed_rows(spark, jdbc_table, tmp_path):
    write_jdbc(seed_frame(spark), jdbc_table)
    settings = config(jdbc_table, tmp_path)
    result = run_job(spark, settings)
    assert (result.seeded, result.rows) == (False, 8)
    assert result.silhouette == pytest.approx(0.551619, abs=1e-6)
    back = read_jdbc(spark, settings.target)
    assert back.columns == [*FEATURES, "cluster"]
    assert dict(back.dtypes)["cluster"] == "int"
    assert back.count() == 8 and back.select("cluster").distinct().count() == 5
    assert len(load_kmeans(result.model_path).clusterCenters()) == 5
    raw = seed_frame(spark)
    scored = load_scoring_model(result.scoring_model_path).transform(raw)
    assert scored.select("cluster").distinct().count() == 5


def test_job_seeds_first(spark, jdbc_table, tmp_path):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    path = tmp_path / "seed"
    lines.select(*names).write.csv(str(path), sep="\t", header=True)
    settings = config(
        jdbc_table, tmp_path, features=tuple(names), bounds={"l_quantity": (0, 25)},
        seed_path=str(path), seed_limit=3_000, seed_order=tuple(names),
        source_options={"partition_column": "l_extendedprice", "num_partitions": 3},
        target_options={"num_partitions": 2},
    )
    first, again = run_job(spark, settings), run_job(spark, settings)
    assert (first.seeded, again.seeded) == (True, False)
    assert table_row_count(spark, settings.source) == 3_000
    expected = read_jdbc(spark, settings.source).filter("l_quantity <= 25").count()
    assert first.rows == again.rows == table_row_count(spark, settings.target) == expected


def test_faults_end_the_job(spark, jdbc_table, tmp_path):
    with pytest.raises(Py4JJavaError):
        run_job(spark, config(jdbc_table, tmp_path))
    write_jdbc(seed_frame(spark), jdbc_table)
    with pytest.raises(Exception, match="fibre"):
        run_job(spark, config(jdbc_table, tmp_path, features=(*FEATURES, "fibre_100g")))
    with pytest.raises(Exception, match="k"):
        run_job(spark, config(jdbc_table, tmp_path, k=1))
    assert not os.path.exists(tmp_path / "kmeans")


def test_job_leaves_no_cache_and_no_snapshot(spark, jdbc_table, tmp_path):
    write_jdbc(seed_frame(spark), jdbc_table)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    cached = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    run_job(spark, config(jdbc_table, tmp_path))
    assert set(os.listdir(shared)) == before
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= cached


def test_source_is_read_over_several_connections(spark, jdbc_table, tmp_path, monkeypatch):
    seen = []
    plain = job.extract_jdbc

    def looking(session, table, folder, ranges, **options):
        seen.append(ranges())
        return plain(session, table, folder, seen[-1], **options)

    monkeypatch.setattr(job, "extract_jdbc", looking)
    write_jdbc(seed_frame(spark), jdbc_table)
    run_job(spark, config(jdbc_table, tmp_path, range_rows=2))
    run_job(spark, config(jdbc_table, tmp_path, range_rows=2, partition_column="salt_100g"))
    run_job(spark, config(jdbc_table, tmp_path))
    assert [len(ranges) for ranges in seen] == [4, 4, 1]
    assert "energy_100g" in seen[0][0] and "salt_100g" in seen[1][0]


class Killed(BaseException):
    """What an application that is ended does not handle."""


STAGES = ["extract_jdbc", "clean", "cluster_rows", "write_version", "snapshot", "put_note", "write_jdbc", "switch_version"]


@pytest.mark.parametrize("stage, state", [*((stage, True) for stage in STAGES), ("write_jdbc", False), ("switch_version", False)])
def test_a_run_that_was_killed_is_finished_by_the_next(spark, jdbc_table, tmp_path, monkeypatch, stage, state):
    """Until the labels are in place readers find the run before, and then labels and models of one run."""
    write_jdbc(seed_frame(spark), jdbc_table)
    folder = str(tmp_path / "state") if state else None
    settings = config(jdbc_table, tmp_path, state_path=folder)
    run_job(spark, dataclasses.replace(settings, k=3))
    before = published_run(spark, settings.target)
    assert before == current_version(settings.model_path) == current_version(scoring_path(settings))

    with monkeypatch.context() as patch:
        def kill(*_, **__):
            raise Killed

        patch.setattr(job, stage, kill)
        with pytest.raises(Killed):
            run_job(spark, settings)
    published = stage == "switch_version"
    assert (published_run(spark, settings.target) != before) is published
    assert current_version(settings.model_path) == before
    assert read_jdbc(spark, settings.target).select("cluster").distinct().count() == (5 if published else 3)

    with monkeypatch.context() as patch:
        done = {"write_jdbc": ["extract_jdbc", "clean", "cluster_rows"], "cluster_rows": ["extract_jdbc", "clean"],
                "switch_version": ["extract_jdbc", "cluster_rows", "write_jdbc"]}
        for earlier in done.get(stage, []) if state else []:
            patch.setattr(job, earlier, lambda *_, **__: pytest.fail("done again"))
        result = run_job(spark, settings)
    run = published_run(spark, settings.target)
    assert run == current_version(settings.model_path) == current_version(scoring_path(settings)) != before
    assert result.rows == 8 and result.silhouette == pytest.approx(0.551619, abs=1e-6)
    back = read_jdbc(spark, settings.target)
    scored = load_scoring_model(result.scoring_model_path).transform(back.drop("cluster"))
    same = scored.select(*FEATURES, "cluster").collect()
    assert sorted(map(repr, same)) == sorted(map(repr, back.select(*FEATURES, "cluster").collect()))
    assert not state or not any((tmp_path / "state").iterdir())
    assert len(list((tmp_path / "kmeans" / "versions").iterdir())) == 1


def test_other_settings_do_not_take_over_a_state(tmp_path, jdbc_table):
    keys = [stage_keys(config(jdbc_table, tmp_path, **changes)) for changes in ({}, {"k": 4}, {"finite_only": True})]
    assert keys[0]["rows"] == keys[1]["rows"] != keys[2]["rows"]
    assert len({key["fit"] for key in keys}) == 3


def test_results_do_not_depend_on_cores(spark):
    rows = snapshot(seed_frame(spark).coalesce(1), work_dir(spark))
    from clusterloom.plans.job import cluster_rows

    first, second = (cluster_rows(rows, FEATURES) for _ in range(2))
    assert first.silhouette == second.silhouette


def test_defaults():
    settings = JobConfig.from_env({"DB_URL": "jdbc:x", "DB_PASSWORD": "p"}, k=7)
    assert settings.features == tuple(FEATURES)
    assert settings.bounds == FOOD_BOUNDS and "energy_100g" not in settings.bounds
    assert (settings.k, settings.seed, settings.max_iter) == (7, 42, 20)
    assert settings.source.url == "jdbc:x" and settings.source.user == "SYSTEM"
    assert settings.source.table != settings.target.table
    assert settings.seed_limit is None
    with pytest.raises(KeyError):
        JobConfig.from_env({})


# Storage


def test_work_dir_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark), work_dir(spark)
    assert first.startswith(shared) and first != second


class Elsewhere:
    """A session on a cluster without the setting."""

    class conf:
        @staticmethod
        def get(_, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Elsewhere)
    Elsewhere.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Elsewhere)


def test_a_cluster_must_name_a_database():
    from clusterloom.plans.queries import fresh_table

    with pytest.raises(RuntimeError, match="spark.clusterloom.jdbc.url"):
        fresh_table(Elsewhere)


def test_database_from_the_session(spark):
    from clusterloom.plans.queries import fresh_table

    spark.conf.set("spark.clusterloom.jdbc.url", "jdbc:x://host/db")
    spark.conf.set("spark.clusterloom.jdbc.user", "u")
    try:
        table = fresh_table(spark)
    finally:
        spark.conf.unset("spark.clusterloom.jdbc.url")
        spark.conf.unset("spark.clusterloom.jdbc.user")
    assert (table.url, table.user, table.driver) == ("jdbc:x://host/db", "u", None)


def test_work_dir_goes_with_the_application(tmp_path):
    code = (
        "from pyspark.sql import SparkSession; from clusterloom.storage import snapshot, work_dir; "
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}/shared').getOrCreate(); "
        "assert snapshot(s.range(5), work_dir(s)).count() == 5"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not list((tmp_path / "shared").glob("clusterloom-*"))


def test_snapshot_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "rand() as r")
    kept = snapshot(df, work_dir(spark))
    assert kept.dtypes == df.dtypes
    assert sorted(kept.collect()) == sorted(kept.collect())
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_snapshot_does_not_ask_the_database_again(spark, jdbc_table):
    write_jdbc(seed_frame(spark), jdbc_table)
    kept = snapshot(read_jdbc(spark, jdbc_table), work_dir(spark))
    write_jdbc(seed_frame(spark).limit(1), jdbc_table)
    assert kept.count() == 8


def test_persisted_is_released_after_a_failure(spark):
    df = spark.range(10)
    with pytest.raises(ZeroDivisionError), persisted(df) as kept:
        assert kept.count() == 10 and kept.is_cached
        1 / 0
    assert not df.is_cached
