"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.config import FOOD_FEATURES, JobConfig
from clusterloom.database import (
    JdbcTable,
    drop_table,
    is_missing_table,
    is_there,
    query_jdbc,
    table_row_count,
)
from clusterloom.functions.distance import as_vector, nearest, squared_norm
from clusterloom.operators.cleaning import clean, range_profile, select_float
from clusterloom.operators.clustering import (
    assign,
    centers_frame,
    cluster_profile,
    lloyd,
    ranked_label,
)
from clusterloom.operators.counting import null_counts, row_count, word_count
from clusterloom.operators.features import feature_pipeline, feature_stats, standardize
from clusterloom.operators.limiting import take_rows
from clusterloom.operators.quality import dq_report
from clusterloom.operators.silhouette import evaluate_silhouette, silhouette
from clusterloom.plans.job import cluster_rows, run_job
from clusterloom.sinks.jdbc import begin_load, seed_if_absent, write_jdbc, write_result
from clusterloom.sinks.model import load_kmeans, load_scoring_model, save_model
from clusterloom.sources.balance import balanced_predicates
from clusterloom.sources.delimited import read_delimited
from clusterloom.sources.extract import extract_jdbc, missing_ranges
from clusterloom.sources.inline import inline_rows
from clusterloom.sources.jdbc import read_jdbc, read_jdbc_with_retry
from clusterloom.storage import persisted, runs_in_one_process, snapshot, work_dir

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_BOUNDS = {"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.07)}

# Starting centres for the standardised line items. The last one attracts no row.
START_CENTERS = (
    (-1.03, -0.87, -0.52, 0.11),
    (0.12, 0.07, 0.91, -0.63),
    (1.17, 1.31, -0.29, 0.47),
    (90.0, 90.0, 90.0, 90.0),
)
START_ROUNDS = 4

# Fixed centres for the line items as they are.
PRICE_CENTERS = (
    (10.5, 12_000.25, 0.03, 0.02),
    (21.5, 31_000.75, 0.07, 0.05),
    (33.5, 52_000.5, 0.02, 0.07),
    (46.5, 81_000.125, 0.05, 0.01),
)

# The eight rows a new source table starts with, in feature order.
SEED_ROWS = (
    (2000.0, 10.5, 50.0, 5.0, 8.0, 1.2),
    (150.0, 0.5, 3.0, 2.0, 1.0, 0.1),
    (2000.0, 10.5, 50.0, 5.0, 8.0, 1.2),
    (150.0, 0.5, 3.0, 2.0, 1.0, 0.1),
    (800.0, 5.0, 20.0, 15.0, 4.0, 0.5),
    (3000.0, 30.0, 10.0, 1.0, 20.0, 2.0),
    (50.0, 0.1, 10.0, 9.0, 0.5, 0.0),
    (1200.0, 15.0, 40.0, 25.0, 5.0, 1.0),
)
SEED_SCHEMA = ", ".join(f"{f} double" for f in FOOD_FEATURES)

JDBC_URL_SETTING = "spark.clusterloom.jdbc.url"

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__.removeprefix("q_")] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(value: Column, name: str, digits: int = 6) -> Column:
    """Rounded for comparison with another engine; adding 0.0 turns -0.0 into 0.0."""
    return (F.round(value.cast("double"), digits) + F.lit(0.0)).alias(name)


DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def fresh_table(spark: SparkSession) -> JdbcTable:
    """A table name nobody uses yet, in the database the session names.

    ``spark.clusterloom.jdbc.url`` with ``.user``, ``.password`` and
    ``.driver`` name it. A session that is a single process may do without
    and gets Derby in memory, which only that process can see.
    """
    name = f"t_{uuid.uuid4().hex[:20]}"
    url = spark.conf.get(JDBC_URL_SETTING, None)
    if url is None:
        if not runs_in_one_process(spark):
            raise RuntimeError(f"set {JDBC_URL_SETTING} to a database that all executors reach")
        return JdbcTable(url=f"jdbc:derby:memory:{name};create=true", table=name, driver=DERBY)
    prefix = JDBC_URL_SETTING.removesuffix("url")
    login = {key: spark.conf.get(prefix + key, None) for key in ("user", "password", "driver")}
    return JdbcTable(url=url, table=name, **login)


@contextmanager
def scratch_table(spark: SparkSession) -> Iterator[JdbcTable]:
    """A fresh table that is dropped at the end, if it has come into being."""
    table = fresh_table(spark)
    try:
        yield table
    finally:
        drop_quietly(spark, table)


def drop_quietly(spark: SparkSession, table: JdbcTable) -> None:
    try:
        drop_table(spark, table)
    except Py4JJavaError as error:
        if not is_missing_table(spark, error):
            log.warning("%s could not be dropped", table.table)


def kept(df: DataFrame) -> DataFrame:
    """A result on files, so that what it was made from can go."""
    return snapshot(df, f"{work_dir(df.sparkSession)}/result")


def write_tsv(df: DataFrame, path: str, **options) -> None:
    """Files with doubled quotes and a header line, of 20 000 records unless told otherwise."""
    defaults = {
        "sep": "\t",
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxRecordsPerFile": 20_000,
    }
    df.write.options(**{**defaults, **options}).csv(path)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_float(table(spark, sf_dir, "lineitem"), LINE_FEATURES, keep=LINE_KEY)


def _standard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items for passes that are repeated."""
    return standardize(_lines(spark, sf_dir), LINE_FEATURES)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a text column in which sign-ups have no value and errors no number."""
    reading = (
        F.when(F.col("event_type") == "signup", None)
        .when(F.col("event_type") == "error", "error")
        .otherwise(F.col("value").cast("string"))
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", "user_id", "value", reading.alias("reading"))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed at five distinct points, one per region."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customers = table(spark, sf_dir, "customer").select("c_nationkey")
    region = F.col("n_regionkey").cast("double")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        region.alias("x"), (region * region).alias("y")
    )


# Counting and checking


@registered
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


@registered
def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(table(spark, sf_dir, "documents"), "text")


@registered
def q_dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(_readings(spark, sf_dir), ["event_id", "user_id", "value", "reading"])


@registered
def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_report(_readings(spark, sf_dir), ["event_id", "value", "reading", "weight"])


@registered
def q_limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return take_rows(table(spark, sf_dir, "lineitem").select(*order), 50_000, order_by=order)


# Cleaning and features


@registered
def q_clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(_readings(spark, sf_dir), ["reading"], {"reading": (0, 100)}, keep=["event_id"])
    return rows.select("event_id", rounded(F.col("reading"), "reading", 4))


@registered
def q_clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(table(spark, sf_dir, "lineitem"), LINE_FEATURES, LINE_BOUNDS)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[rounded(F.sum(F.col(f).cast("double")), f, 3) for f in LINE_FEATURES],
    )


@registered
def q_range_filter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_profile(table(spark, sf_dir, "lineitem"), LINE_BOUNDS)


@registered
def q_text_range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_profile(_readings(spark, sf_dir), {"reading": (1, 100), "value": (1, 100)})


@registered
def q_feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = feature_stats(_lines(spark, sf_dir), LINE_FEATURES)
    return stats.select("feature", "n", rounded(F.col("mean"), "mean"), rounded(F.col("std"), "std"))


def _standardized_output(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    return df.select(*LINE_KEY, *[rounded(v, f, 4) for f, v in zip(LINE_FEATURES, values)])


@registered
def q_standardized_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir)
    vectors = feature_pipeline(list(LINE_FEATURES)).fit(rows).transform(rows)
    spelled = vectors.select(*LINE_KEY, vector_to_array("features").alias("z"))
    return _standardized_output(spelled, [F.col("z")[i] for i in range(len(LINE_FEATURES))])


@registered
def q_standardized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standardize(_lines(spark, sf_dir), LINE_FEATURES)
    return _standardized_output(rows, [F.col(f) for f in LINE_FEATURES])


# Clustering


@registered
def q_kmeans_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _standard_lines(spark, sf_dir)
    centers = lloyd(rows, LINE_FEATURES, START_CENTERS, max_iter=START_ROUNDS)
    return centers_frame(rows, centers, LINE_FEATURES).select(
        "cluster", *[rounded(F.col(f), f) for f in LINE_FEATURES]
    )


@registered
def q_kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = assign(_lines(spark, sf_dir), LINE_FEATURES, PRICE_CENTERS)
    return labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        *[rounded(F.avg(F.col(f).cast("double")), f, 4) for f in LINE_FEATURES],
    )


@registered
def q_silhouette_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _standard_lines(spark, sf_dir)
    with persisted(assign(rows, LINE_FEATURES, START_CENTERS[:3]).drop(*LINE_KEY)) as labelled:
        found = silhouette(labelled, LINE_FEATURES).first()
    return inline_rows(spark, [tuple(found)], "n bigint, silhouette double").select(
        "n", rounded(F.col("silhouette"), "silhouette")
    )


@registered
def q_silhouette_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign(_standard_lines(spark, sf_dir), LINE_FEATURES, START_CENTERS[:3])
    vectors = rows.select(as_vector(LINE_FEATURES).alias("features"), "cluster")
    with persisted(vectors) as kept:
        found = evaluate_silhouette(kept)
    return inline_rows(spark, [(found,)], "silhouette double").select(
        rounded(F.col("silhouette"), "silhouette")
    )


@registered
def q_kmeans_separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = cluster_rows(kept(_regions(spark, sf_dir)), ["x", "y"], init_steps=5)
    return fitted.predictions.groupBy(ranked_label(fitted.kmeans_model)).agg(
        F.count(F.lit(1)).alias("size"),
        rounded(F.avg("x"), "x"),
        rounded(F.avg("y"), "y"),
        rounded(F.lit(fitted.silhouette), "silhouette"),
    )


@registered
def q_cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items cleaned, standardised and clustered, as facts that hold for any random start.

    Per feature the mean over the clusters, weighted by their sizes, with the
    number of rows, of clusters, and of rows whose nearest centre is another.
    """
    rows = snapshot(clean(table(spark, sf_dir, "lineitem"), LINE_FEATURES, LINE_BOUNDS), f"{work_dir(spark)}/rows")
    fitted = cluster_rows(rows, list(LINE_FEATURES))
    placed = fitted.predictions.withColumn("z", vector_to_array("features"))
    centers = [tuple(map(float, center)) for center in fitted.kmeans_model.clusterCenters()]
    placed = placed.withColumn("astray", (nearest("z", centers) != F.col("cluster")).cast("int"))
    profile = cluster_profile(placed, ("astray", *LINE_FEATURES))
    total = F.sum("size")
    facts = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col("n"),
            F.col("clusters"),
            F.round(F.col("astray")).cast("bigint").alias("astray"),
            rounded(F.col(f), "mean"),
        )
        for f in LINE_FEATURES
    ]
    return profile.agg(
        total.alias("n"),
        F.count(F.lit(1)).alias("clusters"),
        F.sum(F.col("astray") * F.col("size")).alias("astray"),
        *[(F.sum(F.col(f) * F.col("size")) / total).alias(f) for f in LINE_FEATURES],
    ).select(F.inline(F.array(*facts)))


@registered
def q_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark)
    rows = kept(_regions(spark, sf_dir))
    fitted = cluster_rows(rows, ["x", "y"], init_steps=5)
    save_model(fitted.kmeans_model, f"{folder}/kmeans")
    save_model(fitted.scoring_model, f"{folder}/chain")
    labelled = load_scoring_model(f"{folder}/chain").transform(rows)
    return labelled.groupBy(ranked_label(load_kmeans(f"{folder}/kmeans"))).agg(
        F.count(F.lit(1)).alias("size"), rounded(F.avg("x"), "x")
    )


EMBEDDING_WIDTH = 64
EMBEDDING_ROUNDS = 2


def _label_means(vectors: DataFrame) -> list[tuple[int, tuple[float, ...]]]:
    """The mean vector of every label; they start out as centres, which live on the driver."""
    grouped = vectors.groupBy("label").agg(Summarizer.mean(as_vector("embedding")).alias("mean"))
    return [(row["label"], tuple(row["mean"].toArray().tolist())) for row in grouped.orderBy("label").collect()]


@registered
def q_embedding_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("embedding", "label")
    means = _label_means(vectors)
    labels = F.array(*[F.lit(label) for label, _ in means])
    placed = assign(vectors, "embedding", [mean for _, mean in means])
    return placed.groupBy("label", labels[F.col("cluster")].alias("nearest_label")).agg(
        F.count(F.lit(1)).alias("size")
    )


@registered
def q_embedding_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of the embeddings, starting from the mean of every label."""
    vectors = table(spark, sf_dir, "embeddings").select("embedding", "label")
    start = [mean for _, mean in _label_means(vectors)]
    centers = lloyd(vectors, "embedding", start, max_iter=EMBEDDING_ROUNDS)
    names = [f"e{i}" for i in range(EMBEDDING_WIDTH)]
    return centers_frame(vectors, centers, names).select(
        "cluster", *[rounded(F.col(name), name) for name in names[:4]], rounded(squared_norm(names), "norm")
    )


@registered
def q_embedding_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("embedding", "label")
    score = silhouette(vectors, "embedding", cluster_column="label")
    return score.select("n", rounded(F.col("silhouette"), "silhouette"))


# Files and databases


@registered
def q_tsv_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records proved to keep to one line each, so that files are split into tasks."""
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "lineitem").select(*LINE_FEATURES), folder)
    rows = read_delimited(spark, folder, schema=", ".join(f"{f} double" for f in LINE_FEATURES))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[rounded(F.sum(F.col(f).cast("double")), f, 3) for f in LINE_FEATURES],
    )


def _text_facts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5("text").alias("text_md5"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )


@registered
def q_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), folder)
    return _text_facts(read_delimited(spark, folder))


@registered
def q_tsv_open_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts in a file for each task that writes, with their line breaks, cut at the true ends of the records."""
    folder = f"{work_dir(spark)}/tsv"
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    write_tsv(documents, folder, maxRecordsPerFile=0)
    return _text_facts(read_delimited(spark, folder))


@registered
def q_tsv_crlf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the line ends of Windows, whose types are inferred in a split pass."""
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_FEATURES), folder, lineSep="\r\n")
    rows = read_delimited(spark, folder)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_linenumber").cast("bigint")).alias("numbers"),
        F.lit(",".join(kind for _, kind in rows.dtypes)).alias("types"),
        *[rounded(F.sum(F.col(f).cast("double")), f, 3) for f in LINE_FEATURES],
    )


def _order_facts(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_custkey").cast("bigint")).alias("customers"),
        rounded(F.sum(F.col("o_totalprice").cast("double")), "price", 2),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


ORDER_SPLIT = {"partition_column": "o_orderkey", "num_partitions": 8}


@registered
def q_jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch_table(spark) as target:
        write_jdbc(_orders(spark, sf_dir), target)
        return kept(_order_facts(read_jdbc(spark, target, **ORDER_SPLIT)))


@registered
def q_jdbc_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    with scratch_table(spark) as target:
        write_jdbc(orders, target)
        write_jdbc(orders.filter(F.col("o_totalprice") > 100_000), target, truncate=True)
        return kept(_order_facts(read_jdbc(spark, target, **ORDER_SPLIT)))


@registered
def q_jdbc_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch_table(spark) as target:
        write_jdbc(_orders(spark, sf_dir), target)
        return kept(_order_facts(read_jdbc(spark, target, partition_column="o_totalprice", num_partitions=12)))


@registered
def q_jdbc_predicate_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price bands at the quantiles of the table, one of them with the NULLs; every seventh price is missing."""
    orders = _orders(spark, sf_dir).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    )
    shares = [i / 8 for i in range(1, 8)]
    edges = sorted(set(orders.approxQuantile("o_totalprice", shares, 0.01)))
    with scratch_table(spark) as target:
        write_jdbc(orders, target)
        price = target.quoted("o_totalprice")
        bands = [f"{price} >= {low!r} and {price} < {high!r}" for low, high in zip(edges, edges[1:])]
        ends = [f"{price} is null or {price} < {edges[0]!r}", f"{price} >= {edges[-1]!r}"] if edges else ["1 = 1"]
        return kept(_order_facts(read_jdbc(spark, target, predicates=[*ends, *bands])))


@registered
def q_jdbc_failed_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement whose tasks end at the dear orders, after others have committed theirs: the table is as before."""
    orders = _orders(spark, sf_dir)
    fault = F.raise_error(F.lit("the task ends here")).cast("double")
    broken = orders.withColumn("o_totalprice", F.when(F.col("o_totalprice") > 100_000, fault).otherwise(F.col("o_totalprice")))
    with scratch_table(spark) as target:
        write_jdbc(orders.filter(F.col("o_totalprice") > 100_000), target)
        failed = 0
        for truncate in (False, True):
            try:
                write_jdbc(broken, target, truncate=truncate)
            except Exception as error:
                if "the task ends here" not in str(error):
                    raise
                failed += 1
        facts = _order_facts(read_jdbc(spark, target, **ORDER_SPLIT))
        return kept(facts.withColumn("failed", F.lit(failed).cast("bigint")))


@registered
def q_jdbc_skewed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders share a price and every seventh has none; no connection gets more than twice the usual rows."""
    price = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_custkey") % 2 == 0, 1000.0)
    orders = _orders(spark, sf_dir).withColumn("o_totalprice", price.otherwise(F.col("o_totalprice")))
    with scratch_table(spark) as target:
        write_jdbc(orders, target)
        rows = read_jdbc(
            spark, target, balanced_by=["o_totalprice", "o_custkey", "o_orderkey"], num_partitions=16
        )
        sizes = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("size"))
        spread = sizes.agg(
            F.count(F.lit(1)).alias("parts"), (F.max("size") <= 2 * F.median("size")).alias("even")
        ).first()
        facts = _order_facts(rows)
        return kept(
            facts.withColumns({"parts": F.lit(spread["parts"]).cast("bigint"), "even": F.lit(spread["even"])})
        )


@registered
def q_jdbc_resumed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last three of eight ranges need a table that is not there yet; a second call reads only these.

    What both have read must be as many rows as a scan of the table finds.
    """
    folder = f"{work_dir(spark)}/extract"
    with scratch_table(spark) as target:
        gate = target.named(f"{target.table}_gate")
        write_jdbc(_orders(spark, sf_dir), target)
        ranges = balanced_predicates(spark, target, ["o_orderkey"], 8)
        late = [f"({condition}) and 0 = (select count(*) from {gate.table})" for condition in ranges[5:]]
        extract = partial(extract_jdbc, spark, target, folder, [*ranges[:5], *late], connections=4, attempts=1)
        try:
            extract()
        except Py4JJavaError as error:
            if not is_missing_table(spark, error):
                raise
        left = missing_ranges(spark, folder, len(ranges))
        try:
            write_jdbc(_orders(spark, sf_dir).limit(0), gate)
            rows = extract()
            if rows.count() != read_jdbc(spark, target, **ORDER_SPLIT).count():
                raise RuntimeError("the ranges that were read are not the whole table")
            return kept(_order_facts(rows).withColumn("ranges_left", F.lit(len(left)).cast("bigint")))
        finally:
            drop_quietly(spark, gate)


@registered
def q_jdbc_retried_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first address is that of a database which is shutting down, the second answers."""
    down = f"jdbc:derby:memory:d_{uuid.uuid4().hex[:20]}"
    with scratch_table(spark) as target:
        if target.driver != DERBY:
            raise RuntimeError("the unreachable address of this query needs a Derby database")
        write_jdbc(_orders(spark, sf_dir), target)
        query_jdbc(spark, replace(target, url=f"{down};create=true"), "select v as one from (values 1) as t(v)").collect()
        rows = read_jdbc_with_retry(
            spark,
            replace(target, url=f"{down};shutdown=true"),
            attempts=2,
            delay=0.01,
            addresses=[target.url],
            **ORDER_SPLIT,
        )
        return kept(_order_facts(rows))


@registered
def q_seed_rows_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six features of the literal rows, each value with the parts whose size is its whole part."""
    literal = inline_rows(spark, SEED_ROWS, SEED_SCHEMA)
    values = literal.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FOOD_FEATURES]))
    )
    sizes = table(spark, sf_dir, "part").groupBy(F.col("p_size").cast("double").alias("size"))
    sizes = sizes.agg(F.count(F.lit(1)).alias("parts"))
    same = values.join(sizes, F.floor(F.col("value")) == F.col("size"), "left")
    return same.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.sum("value"), "value", 3),
        rounded(F.max("value"), "largest", 3),
        F.coalesce(F.sum("parts"), F.lit(0)).cast("bigint").alias("parts"),
    )


@registered
def q_seed_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight literal rows are too few to count as data; the file replaces them, once."""
    features = ["p_size", "p_retailprice"]
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "part").select("p_name", *features), folder)
    with scratch_table(spark) as target:
        write_jdbc(inline_rows(spark, SEED_ROWS, SEED_SCHEMA), target)
        loads = [seed_if_absent(spark, folder, target, features, journal=None) for _ in range(2)]
        back = read_jdbc(spark, target, partition_column="p_retailprice", num_partitions=8)
        return kept(
            back.agg(
                F.lit(sum(loads)).cast("bigint").alias("loads"),
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("p_size").cast("bigint")).alias("p_size"),
                rounded(F.sum(F.col("p_retailprice").cast("double")), "p_retailprice", 2),
            )
        )


@registered
def q_seed_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load dies at the largest parts; what it and a load without staging leave does not count as filled."""
    features = ["p_size", "p_retailprice"]
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "part").select("p_name", *features), folder)
    with scratch_table(spark) as target:
        journal = target.named(f"{target.table}_loads")
        rows = read_delimited(spark, folder).select(*features)
        fault = F.raise_error(F.lit("the task ends here")).cast("double")
        dying = rows.withColumn("p_retailprice", F.when(F.col("p_size") == 50, fault).otherwise(F.col("p_retailprice")))
        try:
            marks = begin_load(spark, target, journal.table)
            died = 0
            try:
                write_jdbc(dying, target, marks=marks)
            except Exception as error:
                if "the task ends here" not in str(error):
                    raise
                died = 1
            left = table_row_count(spark, target) if is_there(spark, target) else 0
            write_jdbc(rows.limit(11), target)
            loads = [seed_if_absent(spark, folder, target, features, journal=journal.table) for _ in range(2)]
            back = read_jdbc(spark, target, balanced_by=["p_retailprice"], num_partitions=8)
            return kept(
                back.agg(
                    F.lit(died).cast("bigint").alias("died"),
                    F.lit(left).cast("bigint").alias("rows_left"),
                    F.lit(sum(loads)).cast("bigint").alias("loads"),
                    F.count(F.lit(1)).alias("n"),
                    F.sum(F.col("p_size").cast("bigint")).alias("p_size"),
                    rounded(F.sum(F.col("p_retailprice").cast("double")), "p_retailprice", 2),
                )
            )
        finally:
            drop_quietly(spark, journal)


@registered
def q_seed_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with a column that is no number is refused, and the table stays as it was."""
    folder = f"{work_dir(spark)}/tsv"
    write_tsv(table(spark, sf_dir, "part").select("p_name", "p_size"), folder)
    with scratch_table(spark) as target:
        write_jdbc(inline_rows(spark, SEED_ROWS, SEED_SCHEMA), target)
        try:
            seed_if_absent(spark, folder, target, ["p_name", "p_size"], journal=None)
            refused = ""
        except ValueError as fault:
            refused = str(fault)
        left = read_jdbc(spark, target, partition_column="salt_100g", num_partitions=2).count()
        return kept(
            table(spark, sf_dir, "part").agg(
                F.count(F.lit(1)).alias("parts"),
                F.lit(refused).alias("fault"),
                F.lit(left).cast("bigint").alias("rows_left"),
            )
        )


@registered
def q_cluster_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).drop(*LINE_KEY)
    labelled = assign(rows, LINE_FEATURES, PRICE_CENTERS).withColumn("features", as_vector(LINE_FEATURES))
    with scratch_table(spark) as target:
        write_result(labelled, target, LINE_FEATURES)
        back = read_jdbc(spark, target, partition_column="l_extendedprice", num_partitions=8)
        return kept(
            back.groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(
                F.count(F.lit(1)).alias("size"),
                *[rounded(F.avg(F.col(f).cast("double")), f, 4) for f in LINE_FEATURES],
            )
        )


@registered
def q_clustering_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, from a delimited file over two database tables."""
    folder = work_dir(spark)
    write_tsv(_regions(spark, sf_dir), f"{folder}/seed")
    with scratch_table(spark) as source:
        target = source.named(f"{source.table}_result")
        try:
            result = run_job(
                spark,
                JobConfig(
                    source=source,
                    target=target,
                    features=("x", "y"),
                    bounds={"x": (0.0, 100.0)},
                    init_steps=5,
                    model_path=f"{folder}/kmeans",
                    seed_path=f"{folder}/seed",
                    connect_attempts=1,
                ),
            )
            back = read_jdbc(spark, target, partition_column="y", num_partitions=4)
            members = back.groupBy(F.col("x").cast("bigint").alias("region")).agg(
                F.count(F.lit(1)).alias("size"), F.countDistinct("cluster").alias("clusters")
            )
            return kept(
                members.select(
                    "region",
                    "size",
                    "clusters",
                    F.lit(result.rows).cast("bigint").alias("rows"),
                    rounded(F.lit(result.silhouette), "silhouette"),
                )
            )
        finally:
            drop_quietly(spark, target)
