"""The registered queries as SQL text for another engine.

Written apart from the operators: only the constants of the queries are
shared. ``cluster_profile`` asks for what no random start of K-Means changes.
"""

from __future__ import annotations

from clusterloom.config import FOOD_FEATURES
from clusterloom.plans.queries import (
    EMBEDDING_ROUNDS,
    EMBEDDING_WIDTH,
    LINE_BOUNDS,
    LINE_FEATURES,
    LINE_KEY,
    PRICE_CENTERS,
    SEED_ROWS,
    START_CENTERS,
    START_ROUNDS,
)

READING = (
    "select event_id, user_id, value, case event_type when 'signup' then null when 'error' then 'error' "
    "else value::varchar end as reading from events"
)

STANDARD = (
    "lines as (select " + ", ".join(LINE_KEY) + ", " + ", ".join(f"{f}::float::double as {f}" for f in LINE_FEATURES)
    + " from lineitem), stats as (select "
    + ", ".join(f"avg({f}) as m{i}, stddev_samp({f}) as s{i}" for i, f in enumerate(LINE_FEATURES))
    + " from lines), standard as (select " + ", ".join(LINE_KEY) + ", "
    + ", ".join(f"case when s{i} = 0 then 0 else ({f} - m{i}) / s{i} end as {f}" for i, f in enumerate(LINE_FEATURES))
    + " from lines, stats)"
)


def _r(expression: str, digits: int = 6) -> str:
    return f"round(({expression})::double, {digits}) + 0.0"


def _distance(table: str, center: str) -> str:
    return " + ".join(
        f"({table}.{f} - {center}.{f}) * ({table}.{f} - {center}.{f})" for f in LINE_FEATURES
    )


def _values(centers) -> str:
    rows = ", ".join(
        "(" + ", ".join([str(j), *[f"{v!r}::double" for v in center]]) + ")" for j, center in enumerate(centers)
    )
    return f"select * from (values {rows}) as v(cluster, {', '.join(LINE_FEATURES)})"


def _lloyd() -> str:
    steps = [f"with {STANDARD}", f"c0 as ({_values(START_CENTERS)})"]
    steps.append("points as (select row_number() over () as id, * from standard)")
    for i in range(START_ROUNDS):
        steps.append(
            f"a{i} as (select p.id, " + ", ".join(f"any_value(p.{f}) as {f}" for f in LINE_FEATURES)
            + f", arg_min(c.cluster, {_distance('p', 'c')}) as cluster from points p, c{i} c group by p.id)"
        )
        steps.append(
            f"c{i + 1} as (select o.cluster, "
            + ", ".join(f"coalesce(avg(a.{f}), any_value(o.{f})) as {f}" for f in LINE_FEATURES)
            + f" from c{i} o left join a{i} a on a.cluster = o.cluster group by o.cluster)"
        )
    last = ", ".join(f"{_r(f)} as {f}" for f in LINE_FEATURES)
    return ", ".join(steps) + f" select cluster, {last} from c{START_ROUNDS}"


def _price_clusters() -> str:
    return (
        f"with lines as (select row_number() over () as id, {', '.join(f'{f}::float::double as {f}' for f in LINE_FEATURES)}"
        f" from lineitem), centers as ({_values(PRICE_CENTERS)}), "
        "placed as (select p.id, " + ", ".join(f"any_value(p.{f}) as {f}" for f in LINE_FEATURES)
        + f", arg_min(c.cluster, {_distance('p', 'c')}) as cluster from lines p, centers c group by p.id) "
        "select cluster{cast}, count(*) as size, "
        + ", ".join(f"{_r(f'avg({f})', 4)} as {f}" for f in LINE_FEATURES)
        + " from placed group by cluster"
    )


def _silhouette_tail(width_names: list[str]) -> str:
    """From ``p(cluster, features)`` to the mean silhouette by the closed form."""
    norm = " + ".join(f"{f} * {f}" for f in width_names)
    dot = " + ".join(f"q.{f} * c.y{i}" for i, f in enumerate(width_names))
    sums = ", ".join(f"sum({f}) as y{i}" for i, f in enumerate(width_names))
    return (
        f"q as (select *, row_number() over () as id, {norm} as xi from p), "
        f"c as (select cluster as k, count(*) as n, sum(xi) as psi, {sums} from q group by cluster), "
        f"d as (select q.id, q.cluster, c.k, c.n, q.xi + c.psi / c.n - 2 * ({dot}) / c.n as dist from q, c), "
        "ab as (select id, max(case when cluster = k then n end) as n, "
        "max(case when cluster = k then dist * n / nullif(n - 1, 0) end) as a, "
        "min(case when cluster <> k then dist end) as b from d group by id), "
        "score as (select count(*) as n, avg(case when n = 1 then 0 when a < b then 1 - a / b "
        "when a > b then b / a - 1 else 0 end) as silhouette from ab)"
    )


_SILHOUETTE = (
    f"with {STANDARD}, centers as ({_values(START_CENTERS[:3])}), "
    "points as (select row_number() over () as id, * from standard), "
    "p as (select " + ", ".join(f"any_value(s.{f}) as {f}" for f in LINE_FEATURES)
    + f", arg_min(c.cluster, {_distance('s', 'c')}) as cluster from points s, centers c group by s.id), "
    + _silhouette_tail(list(LINE_FEATURES))
)

_REGIONS = "(select n_regionkey as r from customer join nation on c_nationkey = n_nationkey)"

_ORDER_FACTS = (
    "select count(*) as n, sum(o_custkey)::bigint as customers, " + _r("sum(o_totalprice)", 2) + " as price from orders"
)


def _bound(feature: str, side: int) -> str:
    return f"{LINE_BOUNDS[feature][side]!r}::float"


def _profile(source: str, bounds: dict[str, tuple[float, float]]) -> str:
    parts = []
    for name, (low, high) in bounds.items():
        parts.append(
            f"select '{name}' as column_name, count(*) filter (where v is null or isnan(v)) as missing, "
            f"count(*) filter (where v < {low}::float) as below, count(*) filter (where v > {high}::float) as above, "
            f"count(*) filter (where v between {low}::float and {high}::float) as kept "
            f"from (select try_cast({name} as float) as v from ({source}) as rows_in)"
        )
    return " union all ".join(parts)


def _embedding_assign() -> str:
    columns = ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(EMBEDDING_WIDTH))
    means = ", ".join(f"avg(e{i}) as e{i}" for i in range(EMBEDDING_WIDTH))
    distance = " + ".join(f"(p.e{i} - c.e{i}) * (p.e{i} - c.e{i})" for i in range(EMBEDDING_WIDTH))
    return (
        f"with p as (select vec_id, label, {columns} from embeddings), "
        f"c as (select label, {means} from p group by label), "
        f"placed as (select p.vec_id, any_value(p.label) as label, arg_min(c.label, {distance}) as nearest_label "
        "from p, c group by p.vec_id) "
        "select label, nearest_label, count(*) as size from placed group by label, nearest_label"
    )


def _embedding_lloyd() -> str:
    names = [f"e{i}" for i in range(EMBEDDING_WIDTH)]
    columns = ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(EMBEDDING_WIDTH))
    distance = " + ".join(f"(p.{e} - c.{e}) * (p.{e} - c.{e})" for e in names)
    steps = [
        f"p as (select vec_id, label, {columns} from embeddings)",
        "c0 as (select (dense_rank() over (order by label) - 1)::integer as cluster, * exclude (label) from "
        f"(select label, {', '.join(f'avg({e}) as {e}' for e in names)} from p group by label))",
    ]
    for i in range(EMBEDDING_ROUNDS):
        steps.append(
            f"a{i} as (select p.vec_id, {', '.join(f'any_value(p.{e}) as {e}' for e in names)}, "
            f"arg_min(c.cluster, {distance}) as cluster from p, c{i} c group by p.vec_id)"
        )
        steps.append(
            f"c{i + 1} as (select o.cluster, "
            + ", ".join(f"coalesce(avg(a.{e}), any_value(o.{e})) as {e}" for e in names)
            + f" from c{i} o left join a{i} a on a.cluster = o.cluster group by o.cluster)"
        )
    shown = ", ".join(f"{_r(e)} as {e}" for e in names[:4])
    norm = " + ".join(f"{e} * {e}" for e in names)
    return f"with {', '.join(steps)} select cluster, {shown}, {_r(norm)} as norm from c{EMBEDDING_ROUNDS}"


def _embedding_silhouette() -> str:
    names = [f"e{i}" for i in range(EMBEDDING_WIDTH)]
    columns = ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(EMBEDDING_WIDTH))
    return (
        f"with p as (select label as cluster, {columns} from embeddings), {_silhouette_tail(names)} "
        f"select n, {_r('silhouette')} as silhouette from score"
    )


_IN_BOUNDS = " and ".join(
    f"{f}::float between {_bound(f, 0)} and {_bound(f, 1)}" for f in LINE_BOUNDS
)

_STANDARD_ROWS = (
    f"with {STANDARD} select " + ", ".join(LINE_KEY) + ", "
    + ", ".join(f"{_r(f, 4)} as {f}" for f in LINE_FEATURES) + " from standard"
)

ORACLES: dict[str, str] = {
    "row_count": "select count(*) as row_count from lineitem",
    "word_count": (
        'select word, count(*) as "count" from (select unnest(string_split(text, \' \')) as word from documents) '
        "group by word"
    ),
    "dq_null_counts": (
        "select " + ", ".join(f"count(*) filter (where {c} is null) as {c}" for c in ("event_id", "user_id", "value", "reading"))
        + f" from ({READING})"
    ),
    "dq_report": (
        "select 'event_id' as column_name, true as present, true as type_ok, "
        "count(*) filter (where event_id is null) as null_count from events "
        "union all select 'value', true, true, count(*) filter (where value is null) from events "
        f"union all select 'reading', true, false, count(*) filter (where reading is null) from ({READING}) "
        "union all select 'weight', false, false, null"
    ),
    "limit_rows": (
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem "
        "order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice limit 50000"
    ),
    "clean_features": (
        f"select event_id, {_r('x', 4)} as reading from (select event_id, try_cast(reading as float) as x from ({READING})) "
        "where x is not null and not isnan(x) and x between 0 and 100"
    ),
    "clean_numeric": (
        "select count(*) as n, " + ", ".join(f"{_r(f'sum({f}::float::double)', 3)} as {f}" for f in LINE_FEATURES)
        + f" from lineitem where {_IN_BOUNDS}"
    ),
    "range_filter_profile": _profile("select * from lineitem", LINE_BOUNDS),
    "text_range_profile": _profile(READING, {"reading": (1, 100), "value": (1, 100)}),
    "feature_stats": " union all ".join(
        f"select '{f}' as feature, count(*) as n, {_r(f'avg({f}::float::double)')} as mean, "
        f"{_r(f'stddev_samp({f}::float::double)')} as std from lineitem"
        for f in LINE_FEATURES
    ),
    "standardized_features": _STANDARD_ROWS,
    "standardized_columns": _STANDARD_ROWS,
    "kmeans_lloyd": _lloyd(),
    "kmeans_assign": _price_clusters().replace("{cast}", ""),
    "cluster_result_table": _price_clusters().replace("{cast}", "::bigint as cluster"),
    "silhouette_score": f"{_SILHOUETTE} select n, {_r('silhouette')} as silhouette from score",
    "silhouette_evaluator": f"{_SILHOUETTE} select {_r('silhouette')} as silhouette from score",
    "kmeans_separated": (
        "select (dense_rank() over (order by r) - 1)::integer as cluster, size, r::double as x, (r * r)::double as y, "
        f"1.0::double as silhouette from (select r, count(*) as size from {_REGIONS} group by r)"
    ),
    "saved_model": (
        "select (dense_rank() over (order by r) - 1)::integer as cluster, size, r::double as x "
        f"from (select r, count(*) as size from {_REGIONS} group by r)"
    ),
    "clustering_job": (
        "select r::bigint as region, count(*) as size, 1::bigint as clusters, "
        f"sum(count(*)) over ()::bigint as rows, 1.0::double as silhouette from {_REGIONS} group by r"
    ),
    "embedding_assign": _embedding_assign(),
    "embedding_lloyd": _embedding_lloyd(),
    "embedding_silhouette": _embedding_silhouette(),
    "tsv_split_scan": (
        "select count(*) as n, " + ", ".join(f"{_r(f'sum({f})', 3)} as {f}" for f in LINE_FEATURES) + " from lineitem"
    ),
    "tsv_roundtrip": "select doc_id, md5(text) as text_md5, n_chars from documents",
    "tsv_open_records": "select doc_id, md5(text) as text_md5, n_chars from documents",
    "tsv_crlf_scan": (
        "select count(*) as n, sum(l_linenumber)::bigint as numbers, 'int,int,double,double,double,double' as types, "
        + ", ".join(f"{_r(f'sum({f})', 3)} as {f}" for f in LINE_FEATURES) + " from lineitem"
    ),
    "jdbc_roundtrip": _ORDER_FACTS,
    "jdbc_overwrite": f"{_ORDER_FACTS} where o_totalprice > 100000",
    "jdbc_partitioned_scan": _ORDER_FACTS,
    "jdbc_predicate_scan": (
        "select count(*) as n, sum(o_custkey)::bigint as customers, "
        + _r("sum(o_totalprice) filter (where o_orderkey % 7 <> 0)", 2) + " as price from orders"
    ),
    "jdbc_failed_overwrite": (
        _ORDER_FACTS.replace("select ", "select 2::bigint as failed, ", 1) + " where o_totalprice > 100000"
    ),
    "jdbc_skewed_scan": (
        "select count(*) as n, sum(o_custkey)::bigint as customers, "
        + _r("sum(case when o_custkey % 2 = 0 then 1000.0::double else o_totalprice end) filter (where o_orderkey % 7 <> 0)", 2)
        + " as price, 16::bigint as parts, true as even from orders"
    ),
    "jdbc_resumed_scan": _ORDER_FACTS.replace("select ", "select 3::bigint as ranges_left, ", 1),
    "seed_rows_inline": (
        f"select feature, count(*) as n, {_r('sum(value)', 3)} as value, {_r('max(value)', 3)} as largest, "
        "coalesce(sum((select count(*) from part where p_size = floor(value))), 0)::bigint as parts from ("
        + " union all ".join(
            f"select '{name}' as feature, unnest([{', '.join(repr(row[i]) for row in SEED_ROWS)}])::double as value"
            for i, name in enumerate(FOOD_FEATURES)
        )
        + ") group by feature"
    ),
    "jdbc_retried_scan": _ORDER_FACTS,
    "seed_refused": (
        "select count(*) as parts, 'column p_name has type string, not a numeric one' as fault, "
        "8::bigint as rows_left from part"
    ),
    "cluster_profile": " union all ".join(
        f"select '{f}' as feature, count(*) as n, 5::bigint as clusters, 0::bigint as astray, "
        f"{_r(f'avg({f}::float::double)')} as mean from lineitem where {_IN_BOUNDS}"
        for f in LINE_FEATURES
    ),
    "seed_after_crash": (
        "select 1::bigint as died, 0::bigint as rows_left, 1::bigint as loads, count(*) as n, "
        f"sum(p_size)::bigint as p_size, {_r('sum(p_retailprice)', 2)} as p_retailprice from part"
    ),
    "seed_if_absent": (
        f"select 1::bigint as loads, count(*) as n, sum(p_size)::bigint as p_size, {_r('sum(p_retailprice)', 2)} "
        "as p_retailprice from part"
    ),
}
