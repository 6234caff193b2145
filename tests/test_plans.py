"""What must not be in the plan of a registered query."""

import pathlib
import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from clusterloom.operators.cleaning import clean
from clusterloom.plans import queries as queries_module
from clusterloom.plans.queries import QUERIES
from tests.conftest import SMALL

ROOT = pathlib.Path(__file__).resolve().parent.parent
# Distances are taken, records cut and task attempts noted in Arrow batches; everything else stays in the JVM.
TAKES_DISTANCES = {
    "kmeans_assign", "kmeans_lloyd", "silhouette_score", "embedding_assign",
    "embedding_lloyd", "embedding_silhouette", "cluster_profile", "cluster_result_table", "clustering_job",
    "kmeans_separated", "saved_model",
}
WRITES_TABLES = {name for name in QUERIES if name.startswith(("jdbc_", "seed_"))} - {"seed_rows_inline"}
CUTS_RECORDS = {"tsv_roundtrip", "tsv_open_records", "tsv_crlf_scan"}
NOT_WANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas")


@pytest.fixture
def plans(monkeypatch):
    """Physical plans of everything that runs, eager jobs of an operator included."""
    seen = []

    def watch(kind, name, frame_of):
        plain = getattr(kind, name)

        def watched(self, *args, **options):
            seen.append(frame_of(self)._jdf.queryExecution().executedPlan().toString())
            return plain(self, *args, **options)

        monkeypatch.setattr(kind, name, watched)

    for name in ("collect", "count", "isEmpty"):
        watch(DataFrame, name, lambda self: self)
    for name in ("parquet", "save", "csv"):
        watch(DataFrameWriter, name, lambda self: self._df)
    return seen


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_python_rows(spark, plans, name):
    QUERIES[name](spark, SMALL).collect()
    assert plans
    for plan in plans:
        assert not [word for word in NOT_WANTED if word in plan]
    in_batches = any(word in plan for plan in plans for word in ("ArrowEvalPython", "MapInArrow"))
    assert in_batches == (name in TAKES_DISTANCES | WRITES_TABLES | CUTS_RECORDS)


def test_ranges_reach_a_scan_of_decimals(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id as decimal(38,10)) as d", "cast(id as decimal(9,2)) as e")
    rows.write.parquet(f"{tmp_path}/d")
    found = clean(spark.read.parquet(f"{tmp_path}/d"), ["d", "e"], {"d": (10, 20), "e": (0, 15)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(d" in pushed and "LessThanOrEqual(e" in pushed
    assert sorted(r["d"] for r in found.collect()) == [10.0, 11.0, 12.0, 13.0, 14.0, 15.0]


@pytest.mark.parametrize(
    "name", [n for n in sorted(QUERIES) if n.startswith("jdbc") or n in ("seed_if_absent", "cluster_result_table")]
)
def test_tables_are_read_over_several_connections(spark, monkeypatch, name):
    parts = []
    plain = queries_module.read_jdbc
    monkeypatch.setattr(queries_module, "read_jdbc", lambda *a, **o: watched(plain(*a, **o)))
    monkeypatch.setattr(queries_module, "read_jdbc_with_retry", lambda *a, **o: watched(retry(*a, **o)))

    def watched(df):
        parts.append(df.rdd.getNumPartitions())
        return df

    QUERIES[name](spark, SMALL).collect()
    assert parts and min(parts) > 1


retry = queries_module.read_jdbc_with_retry


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["kmeans_assign"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    }


def test_assigned_rows_are_averaged_before_the_shuffle(spark):
    plan = QUERIES["kmeans_assign"](spark, SMALL)._jdf.queryExecution()
    assert "partial_avg" in plan.executedPlan().toString()


def test_library_uses_no_local_checkpoint_and_no_rdd_code():
    paths = [p for p in (ROOT / "clusterloom").rglob("*.py") if "llm" not in p.parts]
    text = "\n".join(p.read_text() for p in paths)
    for word in ("localCheckpoint", "crossJoin", "toPandas", ".rdd.map", "foreachPartition", "mapPartitions"):
        assert word not in text
