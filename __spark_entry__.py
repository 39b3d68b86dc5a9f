"""

``queries()`` maps each registered query to its Spark implementation
(``driftwatch.plans.queries``); ``oracle_sql()`` gives the same result as
plain SQL that DuckDB runs on the same parquet tables, written
independently of the Spark code (its own period, rounding and calendar
arithmetic) so that the two cross-check each other.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from driftwatch.plans import queries as Q



def _there(module: str) -> bool:
    try:
        return importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:
        return False


# The corpus operators and their pipeline can be taken out; everything else works without them.
llm_queries, LLM_ORACLE, corpus_pipeline = None, {}, None
if _there("driftwatch.llm.queries"):
    from driftwatch.llm import queries as llm_queries
    from driftwatch.llm.oracle import ORACLE as LLM_ORACLE

    if _there("corpus_pipeline"):
        import corpus_pipeline

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly deviations of lineitem (every month vs the one before)."""
    return Q.deviations_month(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**Q.REGISTRY, **(llm_queries.REGISTRY if llm_queries else {}), **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {})}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

# Column lists of the driver's tables (name, Spark type label).
TABLE_COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
        ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
    ],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}
# customer with a derived double that is NaN for every negative balance
TABLE_COLUMNS["customer_sqrt"] = TABLE_COLUMNS["customer"] + [("acctbal_sqrt", "double")]
TABLE_COLUMNS["lineitem_large"] = [("l_orderkey", "bigint"), ("large", "bigint")]
TABLE_COLUMNS["events_nested"] = [("times", "array<timestamp_ntz>"), ("zeros", "array<double>"), ("below", "decimal(38,20)")]
NUMERIC_TYPES = {"bigint", "int", "double", "float", "smallint", "tinyint", "boolean"}
METRICS = ["rows_cnt", "completed_rows_cnt", "nulls_cnt", "distinct_values_cnt", "minimum_value", "maximum_value", "median_value", "average_value", "sum_of_values"]
VALUE_METRICS = METRICS[4:]
WEEK_ANCHOR = "1970-01-04"
STAMP = "2024-03-01 12:00:00"
STAMP_2 = "2024-03-02 12:00:00"
STAMP_2_OPEN = "2024-03-02 12:00:01"
STAMP_OPEN = "2024-03-01 12:00:01"
RUN_DATE = "1998-07-01"
RUN_DATE_BETWEEN = "2001-11-01"
DATED = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
WHOLE = ["customer", "supplier", "part", "nation", "region", "embeddings", "documents", "labels", "pages", "benchmark", "conversations"]
ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# The description wording the deviations must reproduce
# (the same text as driftwatch.config.TEMPLATES_RU, restated for the oracle).
ZERO = "Дельта по показателю {m} не считаема, так как значение в одном из срезов = 0"
DELTA = "Отклонение по столбцу {m} "
DUPS = "Имеются полные дубликаты строк"


def _is_num(t: str) -> bool:
    return t in NUMERIC_TYPES or t.startswith("decimal")


def _ids(table: str, date_field: str | None, rule: str) -> dict[str, int]:
    cols = TABLE_COLUMNS[table]
    if rule == "source":
        return {c: i + 1 for i, (c, _) in enumerate(cols) if c != date_field}
    prof = [(c, t) for c, t in cols if c != date_field]
    order = sorted([c for c, t in prof if _is_num(t)], key=lambda s: s.encode()) + sorted(
        [c for c, t in prof if not _is_num(t)], key=lambda s: s.encode()
    )
    return {c: i for i, c in enumerate(order)}


def _half_up_div(a: str, b: str) -> str:
    """Integer division a / b rounded half away from zero (b > 0), HUGEINT."""
    return f"(CASE WHEN ({a}) >= 0 THEN (2 * ({a}) + ({b})) // (2 * ({b})) ELSE -((2 * (-({a})) + ({b})) // (2 * ({b}))) END)"


def _python_round(x: str) -> str:
    """A float rounded to two places by its exact binary value."""
    return f"CAST(format('{{:.2f}}', CAST({x} AS DOUBLE)) AS DOUBLE)"


def _period(date_field: str | None, interval: str | None) -> tuple[str, str]:
    if date_field is None:
        return "CAST(NULL AS DATE)", "CAST(NULL AS DATE)"
    d = f"CAST({date_field} AS DATE)"
    if interval == "day":
        return d, "__pe"
    if interval == "month":
        return f"last_day({d})", "CAST(date_trunc('month', __pe) AS DATE)"
    pe = f"CAST(DATE '{WEEK_ANCHOR}' + CAST(7 * ceil(date_diff('day', DATE '{WEEK_ANCHOR}', {d}) / 7.0) AS INTEGER) AS DATE)"
    return pe, "CAST(__pe - 6 AS DATE)"


def _profile_sql(
    table: str, date_field: str | None = None, interval: str | None = None, rule: str = "v2", dups: bool = False,
    source: str | None = None, label: str | None = None, scale6: bool = False,
) -> str:
    """One SELECT per column (UNION ALL) with stored values and working values (w_*).

    ``source`` replaces the table by a derived relation whose columns are
    ``TABLE_COLUMNS[table]``; ``label`` is the table name written in the rows.
    """
    pe, start = _period(date_field, interval)
    where = f" WHERE {date_field} IS NOT NULL" if date_field else ""
    src = f"(SELECT *, {pe} AS __pe FROM {source or table}{where}) s"
    ids = _ids(table, date_field, rule)
    it = f"'{interval}'" if interval else "NULL"
    parts = []
    for c, t in TABLE_COLUMNS[table]:
        if c == date_field:
            continue
        head = (
            f"SELECT '{label or table}' AS table_name, '{c}' AS column_name, CAST({ids[c]} AS BIGINT) AS column_id, '{t}' AS data_type, "
            f"CAST(NULL AS VARCHAR) AS comment, {start} AS start_of_calculation_period, __pe AS end_of_calculation_period, "
            f"CAST({it} AS VARCHAR) AS interval_type, CAST(count(*) AS BIGINT) AS rows_cnt, CAST(count({c}) AS BIGINT) AS completed_rows_cnt, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS nulls_cnt"
        )
        if _is_num(t):
            v = f"TRY_CAST({c} AS DECIMAL(38,6))"
            s6 = f"sum(CAST({v} * 1000000 AS HUGEINT))"
            k = f"CAST(count({v}) AS HUGEINT)"
            q10 = _half_up_div(f"{s6} * 10000", f"NULLIF({k}, 0)")
            med = f"quantile_cont(TRY_CAST(trunc({c}) AS BIGINT), 0.5)"
            body = (
                f", CAST(count(DISTINCT {v}) AS BIGINT) AS distinct_values_cnt"
                f", {_python_round(f'min({v})')} AS minimum_value"
                f", {_python_round(f'max({v})')} AS maximum_value"
                f", {_python_round(med)} AS median_value"
                f", {_python_round(f'CAST({q10} AS DOUBLE) / 10000000000.0')} AS average_value"
                f", {_python_round(f'sum({v})')} AS sum_of_values"
                + (
                    f", CAST(min({v}) AS DOUBLE) AS s_minimum_value, CAST(max({v}) AS DOUBLE) AS s_maximum_value"
                    f", CAST(CAST({med} AS DECIMAL(38,6)) AS DOUBLE) AS s_median_value"
                    f", CAST({_half_up_div(q10, '10000')} AS DOUBLE) / 1000000.0 AS s_average_value, CAST(sum({v}) AS DOUBLE) AS s_sum_of_values"
                    if scale6 else ""
                )
                + f", CAST(min({v}) AS DOUBLE) AS w_minimum_value, CAST(max({v}) AS DOUBLE) AS w_maximum_value"
                f", {med} AS w_median_value, CAST({q10} AS DOUBLE) / 10000000000.0 AS w_average_value"
                f", CAST(sum({v}) AS DOUBLE) AS w_sum_of_values"
            )
        else:
            nul = "CAST(NULL AS DOUBLE)"
            body = f", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values_cnt" + "".join(
                f", {nul} AS {m}" for m in VALUE_METRICS
            ) + "".join(f", {nul} AS s_{m}" for m in VALUE_METRICS if scale6) + "".join(f", {nul} AS w_{m}" for m in VALUE_METRICS)
        parts.append(f"{head}{body}, __pe FROM {src} GROUP BY __pe")
    union = " UNION ALL ".join(parts)
    if not dups:
        return f"SELECT u.*, CAST(0 AS BIGINT) AS dublicates_cnt FROM ({union}) u"
    cols = ", ".join(c for c, _ in TABLE_COLUMNS[table])
    dup = (
        f"SELECT __pe AS d_pe, sum(n - 1) AS dub FROM (SELECT __pe, {cols}, count(*) AS n FROM {src} GROUP BY ALL) g GROUP BY __pe"
    )
    return (
        f"SELECT u.*, CAST(coalesce(d.dub, 0) AS BIGINT) AS dublicates_cnt FROM ({union}) u "
        f"LEFT JOIN ({dup}) d ON u.__pe IS NOT DISTINCT FROM d.d_pe"
    )


STORED = (
    "table_name, column_name, column_id, data_type, comment, start_of_calculation_period, end_of_calculation_period, "
    "interval_type, rows_cnt, completed_rows_cnt, nulls_cnt, distinct_values_cnt, minimum_value, maximum_value, "
    "median_value, average_value, sum_of_values, dublicates_cnt"
)


def _stored(profile: str) -> str:
    return f"SELECT {STORED} FROM ({profile}) p"


def _delta(cur: str, prev: str, v1: bool = False) -> str:
    m = f"least({cur}, {prev})"
    first = f"WHEN {prev} IS NULL AND {cur} = 0 THEN 100.0 " if v1 else ""
    return (
        f"(CASE {first}WHEN {cur} IS NULL OR {prev} IS NULL THEN NULL "
        f"WHEN {m} <> 0 THEN round_even(abs(({cur} - {prev}) / {m} * 100) * 100, 0) / 100 "
        f"WHEN {cur} = 0 AND {prev} = 0 THEN 0.0 ELSE 100.0 END)"
    )


def _joined(profile: str, scale6: bool = False) -> str:
    """Current rows with the previous snapshot's stored values (prev_*) and its end."""
    prev_cols = ", ".join(f"CAST(pv.{'s_' if scale6 and m in VALUE_METRICS else ''}{m} AS DOUBLE) AS prev_{m}" for m in METRICS)
    return (
        f"WITH p AS ({profile}), "
        "snaps AS (SELECT DISTINCT table_name, interval_type, end_of_calculation_period AS e FROM p), "
        "links AS (SELECT table_name, interval_type, e, lag(e) OVER (PARTITION BY table_name, interval_type ORDER BY e) AS prev_e FROM snaps) "
        f"SELECT c.*, l.prev_e AS prev_end, {prev_cols} FROM p c "
        "JOIN links l ON c.table_name = l.table_name AND c.interval_type IS NOT DISTINCT FROM l.interval_type "
        "AND c.end_of_calculation_period IS NOT DISTINCT FROM l.e "
        "LEFT JOIN p pv ON pv.table_name = c.table_name AND pv.column_name = c.column_name AND pv.column_id = c.column_id "
        "AND pv.data_type = c.data_type AND pv.comment IS NOT DISTINCT FROM c.comment "
        "AND pv.interval_type IS NOT DISTINCT FROM c.interval_type AND pv.end_of_calculation_period = l.prev_e"
    )


def _numtext(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR), '0$', '')"


def _deviations_sql(profile: str, limits: str | None = None, v1: bool = False, scale6: bool = False) -> str:
    j = _joined(profile, scale6)
    if limits:
        lim_cols = ", ".join(f"coalesce(lm.{m}_limit, CAST(10 AS DECIMAL(19,2))) AS lim_{m}" for m in METRICS)
        base = (
            f"SELECT j.*, {lim_cols} FROM ({j}) j LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER "
            "(PARTITION BY table_name, column_name ORDER BY period_from_dttm DESC) AS rn FROM (" + limits + ") x) y WHERE rn = 1) lm "
            "ON lm.table_name = j.table_name AND lm.column_name = j.column_name"
        )
    else:
        base = f"SELECT j.*, " + ", ".join(f"CAST(10 AS DECIMAL(19,2)) AS lim_{m}" for m in METRICS) + f" FROM ({j}) j"
    cur = {m: (f"CAST(b.{m} AS DOUBLE)" if m.endswith("_cnt") else f"b.w_{m}") for m in METRICS}
    prev = {m: f"b.prev_{m}" for m in METRICS}
    deltas = ", ".join(f"{_delta(cur[m], prev[m], v1)} AS delta_{m}" for m in METRICS)
    curs = ", ".join(f"{cur[m]} AS cur_{m}" for m in METRICS)
    d = f"SELECT b.*, {curs}, {deltas} FROM ({base}) b"
    flag = {m: f"coalesce(d.delta_{m} > d.lim_{m}, false)" for m in METRICS}
    texts = []
    for m in METRICS:
        c, p = f"d.cur_{m}", f"d.prev_{m}"
        texts.append(
            f"CASE WHEN {flag[m]} THEN CASE WHEN ({c} = 0 OR {p} = 0) AND {c} IS DISTINCT FROM {p} THEN '{ZERO.format(m=m)}' "
            f"ELSE '{DELTA.format(m=m)}' || {_numtext('d.delta_' + m)} || '{'%' if v1 else ' %'}' END END"
        )
    dup = "coalesce(d.dublicates_cnt > 0, false)"
    texts.append(f"CASE WHEN {dup} THEN '{DUPS}' END")
    any_flag = " OR ".join([flag[m] for m in METRICS] + [dup])
    cols = []
    for m in METRICS:
        cols.append(f"d.{m}")
        cols.append(f"CAST(CAST(d.delta_{m} AS DECIMAL(38,2)) AS DOUBLE) AS delta_{m}")
    extra = ""
    if v1:
        extra = (
            ", coalesce(d.prev_end, DATE '2000-01-01') AS comparison_dt"
            f", TIMESTAMP '{STAMP_OPEN}' AS period_from_dt, TIMESTAMP '2100-01-01 00:00:00' AS period_to_dt"
        )
    return (
        "SELECT d.table_name, d.column_name, d.comment, d.data_type, d.column_id, d.end_of_calculation_period, d.interval_type, "
        + ", ".join(cols)
        + f", d.dublicates_cnt, CAST(CASE WHEN {any_flag} THEN 1 ELSE 0 END AS BIGINT) AS deviation_flg, "
        + f"concat_ws(', ', {', '.join(texts)}) AS deviation_desc{extra} FROM ({d}) d"
    )


def _limits_sql() -> str:
    """The limits log the Spark query derives from lineitem (two versions per numeric column)."""
    numeric = [c for c, t in TABLE_COLUMNS["lineitem"] if c != "l_shipdate" and c not in ("l_returnflag", "l_linestatus")]
    names = " UNION ALL ".join(f"SELECT '{c}' AS column_name" for c in numeric)
    d = lambda x: f"CAST({x} AS DECIMAL(19,2))"
    v1 = ", ".join(f"{d(5)} AS {m}_limit" for m in METRICS)
    v2_vals = {"rows_cnt": 25.5, "completed_rows_cnt": 25.5, "nulls_cnt": "NULL", "distinct_values_cnt": 15, "minimum_value": 50,
               "maximum_value": 50, "median_value": 20, "average_value": "NULL", "sum_of_values": 12.25}
    v2 = ", ".join(f"{d(v2_vals[m])} AS {m}_limit" for m in METRICS)
    span = "(SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem)"
    return (
        f"SELECT 'lineitem' AS table_name, n.column_name, {v1}, CAST(s.lo AS TIMESTAMP) AS period_from_dttm FROM ({names}) n, {span} s "
        f"UNION ALL SELECT 'lineitem' AS table_name, n.column_name, {v2}, CAST(s.hi AS TIMESTAMP) AS period_from_dttm FROM ({names}) n, {span} s"
    )


def _first_last() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS TABLE_NAME, '{f}' AS TABLE_DATE_FIELD, min(CAST({f} AS DATE)) AS first_day, max(CAST({f} AS DATE)) AS last_day FROM {t}"
        for t, f in DATED.items()
    )


STEP = (
    "CAST(CASE INTERVAL_TYPE WHEN 'day' THEN check_dt + INTERVAL 1 DAY WHEN 'week' THEN check_dt + INTERVAL 7 DAY "
    "ELSE check_dt + INTERVAL 1 MONTH END AS DATE)"
)


def _schedule_steps(run_dt: str = "CAST(last_day + 1 AS DATE)") -> str:
    setup = (
        f"SELECT TABLE_NAME, TABLE_DATE_FIELD, 'day' AS INTERVAL_TYPE, CAST(first_day + 1 AS DATE) AS first_check, {run_dt} AS run_dt FROM fl "
        f"UNION ALL SELECT TABLE_NAME, TABLE_DATE_FIELD, 'week', CAST(first_day + 7 AS DATE), {run_dt} FROM fl "
        f"UNION ALL SELECT TABLE_NAME, TABLE_DATE_FIELD, 'month', last_day(first_day), {run_dt} FROM fl"
    )
    return (
        f"WITH RECURSIVE fl AS ({_first_last()}), setup AS ({setup}), "
        "steps(TABLE_NAME, TABLE_DATE_FIELD, INTERVAL_TYPE, check_no, check_dt, run_dt) AS ("
        "SELECT TABLE_NAME, TABLE_DATE_FIELD, INTERVAL_TYPE, 0, first_check, run_dt FROM setup UNION ALL "
        f"SELECT TABLE_NAME, TABLE_DATE_FIELD, INTERVAL_TYPE, check_no + 1, {STEP}, run_dt FROM steps WHERE check_dt <= run_dt) "
    )


def _v1_steps() -> str:
    code = "CASE TABLE_NM WHEN 'events' THEN 1 WHEN 'orders' THEN 2 ELSE 3 END"
    step = lambda d: (
        f"CAST(CASE INTERVAL_TERM WHEN 1 THEN {d} + 1 WHEN 2 THEN {d} + 7 ELSE {d} + CAST(day(last_day({d})) AS INTEGER) END AS DATE)"
    )
    return (
        f"WITH RECURSIVE fl AS ({_first_last()}), "
        f"setup AS (SELECT TABLE_NAME AS TABLE_NM, first_day AS u0, CAST(first_day + 1 AS DATE) AS c0, {code.replace('TABLE_NM', 'TABLE_NAME')} AS INTERVAL_TERM, last_day, TABLE_DATE_FIELD FROM fl), "
        "w(TABLE_NM, INTERVAL_TERM, step, u, c, last_day) AS ("
        "SELECT TABLE_NM, INTERVAL_TERM, 0, u0, c0, last_day FROM setup UNION ALL "
        f"SELECT TABLE_NM, INTERVAL_TERM, step + 1, {step('u')}, {step('c')}, last_day FROM w WHERE u <= last_day) "
    )


def oracle_sql() -> dict[str, str]:
    month = _profile_sql("lineitem", "l_shipdate", "month")
    week_events = _profile_sql("events", "ts", "week")
    whole = " UNION ALL ".join(_stored(_profile_sql(t)) for t in WHOLE)
    sql = {
        "profile_month": _stored(month),
        "profile_month_range": _stored(month),
        "profile_week": _stored(week_events),
        "profile_day": _stored(_profile_sql("events", "ts", "day", rule="source")),
        "profile_tables": whole,
        "profile_orders_month_dups": _stored(_profile_sql("orders", "o_orderdate", "month", dups=True)),
        "source_duplicates": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(sum(n - 1) AS BIGINT) AS dublicates_cnt FROM (SELECT *, count(*) AS n FROM {t} GROUP BY ALL) g"
            for t in ALL_TABLES
        ),
        "deviations_month": _deviations_sql(month),
        "profile_nan": _stored(_profile_sql("customer_sqrt", source="(SELECT *, sqrt(c_acctbal) AS acctbal_sqrt FROM customer)", label="customer")),
        "profile_large_values": _stored(
            _profile_sql("lineitem_large", source="(SELECT l_orderkey, l_orderkey * 1000000000000 AS large FROM lineitem)", label="lineitem")
        ),
        "profile_nested": _stored(
            _profile_sql(
                "events_nested", label="events",
                source="(SELECT [TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(event_id % 7)] AS times, "
                "[CAST(event_id % 7 - (event_id % 7) % 2 AS DOUBLE)] AS zeros, "
                "CAST(event_id % 3 AS DECIMAL(38,20)) - CAST('0.00000000000000000001' AS DECIMAL(38,20)) AS below FROM events)",
            )
        ),
        "nan_to_null": (
            "SELECT c_custkey, CASE WHEN isnan(sqrt(c_acctbal)) OR isinf(sqrt(c_acctbal)) THEN NULL ELSE sqrt(c_acctbal) END AS acctbal_sqrt FROM customer"
        ),
        "deviations_week": _deviations_sql(week_events),
        "deviations_month_limits": _deviations_sql(month, _limits_sql()),
        "deviations_day_v1": _deviations_sql(_profile_sql("events", "ts", "day", rule="source"), v1=True),
        "join_prev": (
            "SELECT table_name, column_name, column_id, end_of_calculation_period, prev_end, "
            + ", ".join(f"prev_{m}" for m in METRICS)
            + f" FROM ({_joined(month)}) j"
        ),
        "join_prev_added_column": (
            "SELECT table_name, column_name, column_id, CASE column_name WHEN 'value' THEN 1 WHEN 'user_id' THEN 2 WHEN 'event_type' THEN 3 "
            "WHEN 'props' THEN 4 ELSE 5 END AS identity, end_of_calculation_period, prev_end, "
            + ", ".join(f"CASE WHEN column_name <> 'event_id' OR prev_end > DATE '2024-01-14' THEN prev_{m} END AS prev_{m}" for m in METRICS)
            + f" FROM ({_joined(week_events)}) j WHERE end_of_calculation_period > DATE '2024-01-14'"
        ),
        "previous_snapshot": (
            f"SELECT {STORED} FROM (SELECT *, rank() OVER (PARTITION BY table_name, interval_type ORDER BY end_of_calculation_period DESC) AS rnk "
            f"FROM ({_stored(month)}) h WHERE end_of_calculation_period < DATE '1998-07-14') x WHERE rnk = 1"
        ),
        "relabel_table": _stored(month).replace(f"SELECT {STORED}", "SELECT 'lineitem_v' AS table_name" + STORED[len("table_name"):], 1),
    }
    dev = _deviations_sql(month)
    sql["scd2_versions"] = (
        f"SELECT table_name, column_name, end_of_calculation_period, rows_cnt, delta_rows_cnt, deviation_flg, "
        f"TIMESTAMP '{STAMP}' AS period_from_dt, TIMESTAMP '{STAMP_2}' AS period_to_dt FROM ({dev}) a UNION ALL "
        f"SELECT table_name, column_name, end_of_calculation_period, rows_cnt, delta_rows_cnt, deviation_flg, "
        f"TIMESTAMP '{STAMP_2_OPEN}' AS period_from_dt, TIMESTAMP '2100-01-01 00:00:00' AS period_to_dt FROM ({dev}) b"
    )
    year = "year(end_of_calculation_period) = 1996"
    keep = "table_name, column_name, end_of_calculation_period, rows_cnt, delta_rows_cnt, deviation_flg"
    sql["scd2_upsert"] = (
        f"SELECT {keep}, TIMESTAMP '{STAMP_OPEN}' AS period_from_dt, "
        f"CASE WHEN {year} THEN TIMESTAMP '{STAMP_2}' ELSE TIMESTAMP '2100-01-01 00:00:00' END AS period_to_dt FROM ({dev}) a UNION ALL "
        f"SELECT {keep}, TIMESTAMP '{STAMP_2_OPEN}' AS period_from_dt, TIMESTAMP '2100-01-01 00:00:00' AS period_to_dt FROM ({dev}) b WHERE {year}"
    )
    # table structure from DESCRIBE of every table
    type_map = (
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
        "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' "
        "WHEN 'DATE' THEN 'date' WHEN 'FLOAT' THEN 'float' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END"
    )
    described = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, {type_map} AS data_type, row_number() OVER () AS pos FROM (DESCRIBE {t}) d"
        for t in ALL_TABLES
    )
    dated = " OR ".join(f"(table_name = '{t}' AND column_name = '{f}')" for t, f in DATED.items())
    num = ", ".join(f"'{t}'" for t in sorted(NUMERIC_TYPES))
    sql["table_structure"] = (
        f"WITH d AS ({described}), c AS (SELECT *, CASE WHEN data_type IN ({num}) THEN 'numeric' ELSE 'text' END AS column_class "
        f"FROM d WHERE NOT ({dated})) "
        "SELECT table_name, column_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY column_class, column_name) - 1 AS BIGINT) AS column_id, "
        "CAST(pos AS BIGINT) AS source_column_id, data_type, split_part(data_type, '(', 1) AS base_type, column_class, "
        "CAST(NULL AS VARCHAR) AS comment FROM c"
    )
    sql["period_bounds"] = (
        "WITH c AS (SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) + 1 AS DATE) AS check_dt FROM lineitem), "
        "i AS (SELECT 'day' AS interval_type UNION ALL SELECT 'week' UNION ALL SELECT 'month') "
        "SELECT check_dt, interval_type, CAST(check_dt - 1 AS DATE) AS history_end, "
        "CASE interval_type WHEN 'day' THEN CAST(check_dt - 1 AS DATE) WHEN 'week' THEN CAST(check_dt - 7 AS DATE) "
        "ELSE CAST(date_trunc('month', CAST(check_dt - 1 AS DATE)) AS DATE) END AS start_of_calculation_period, "
        "CASE interval_type WHEN 'month' THEN last_day(CAST(check_dt - 1 AS DATE)) ELSE CAST(check_dt - 1 AS DATE) END AS end_of_calculation_period "
        "FROM c, i"
    )
    nxt = (
        "CAST(CASE INTERVAL_TYPE WHEN 'day' THEN check_dt + INTERVAL 1 DAY WHEN 'week' THEN check_dt + INTERVAL 7 DAY "
        "ELSE check_dt + INTERVAL 1 MONTH END AS DATE)"
    )
    end = "CAST(check_dt - 1 AS DATE)"
    sql["schedule_advance"] = _schedule_steps() + (
        f"SELECT TABLE_NAME, INTERVAL_TYPE, CAST(check_no AS BIGINT) AS check_no, check_dt, {end} AS history_end, "
        f"CASE INTERVAL_TYPE WHEN 'day' THEN {end} WHEN 'week' THEN CAST(check_dt - 7 AS DATE) ELSE CAST(date_trunc('month', {end}) AS DATE) END AS start_of_calculation_period, "
        f"CASE INTERVAL_TYPE WHEN 'month' THEN last_day({end}) ELSE {end} END AS end_of_calculation_period, {nxt} AS next_check_dt "
        "FROM steps WHERE check_dt <= run_dt"
    )
    log = "SELECT TABLE_NAME, TABLE_DATE_FIELD, check_dt AS NEXT_CHECK_DT, INTERVAL_TYPE FROM steps WHERE check_dt <= run_dt"
    sql["due_checks"] = _schedule_steps() + (
        f", lg AS ({log}) SELECT TABLE_NAME, TABLE_DATE_FIELD, NEXT_CHECK_DT, INTERVAL_TYPE FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY TABLE_NAME, INTERVAL_TYPE ORDER BY NEXT_CHECK_DT DESC) AS rn FROM lg WHERE NEXT_CHECK_DT <= DATE '{RUN_DATE}') x WHERE rn = 1"
    )
    sql["due_checks_latest"] = _schedule_steps() + (
        f", lg AS ({log}) SELECT TABLE_NAME, TABLE_DATE_FIELD, NEXT_CHECK_DT, INTERVAL_TYPE FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY TABLE_NAME, INTERVAL_TYPE ORDER BY NEXT_CHECK_DT DESC) AS rn FROM lg) x WHERE rn = 1 AND NEXT_CHECK_DT <= DATE '{RUN_DATE_BETWEEN}'"
    )
    sql["due_checks_all"] = _schedule_steps() + (
        f", lg AS ({log}) SELECT TABLE_NAME, TABLE_DATE_FIELD, NEXT_CHECK_DT, INTERVAL_TYPE FROM (SELECT *, row_number() OVER "
        "(PARTITION BY TABLE_NAME, INTERVAL_TYPE ORDER BY NEXT_CHECK_DT DESC) AS rn FROM lg) x WHERE rn = 1 AND NEXT_CHECK_DT <= DATE '2030-01-01'"
    )
    sql["checked_tables"] = _schedule_steps() + (
        f", lg AS ({log}), "
        f"r AS (SELECT DISTINCT TABLE_NAME, INTERVAL_TYPE FROM lg WHERE NEXT_CHECK_DT <= DATE '{RUN_DATE}'), "
        "l AS (SELECT TABLE_NAME, INTERVAL_TYPE, max(NEXT_CHECK_DT) AS m FROM lg GROUP BY ALL) "
        "SELECT 'reference' AS mode, count(*) AS checked_tables FROM r UNION ALL "
        f"SELECT 'latest' AS mode, count(*) AS checked_tables FROM l WHERE m <= DATE '{RUN_DATE}'"
    )
    sql["advanced_states"] = _schedule_steps(f"DATE '{RUN_DATE}'") + (
        ", n AS (SELECT *, " + STEP + " AS next_dt FROM steps WHERE check_dt <= run_dt) "
        "SELECT TABLE_NAME, TABLE_DATE_FIELD, max(next_dt) AS NEXT_CHECK_DT, INTERVAL_TYPE FROM n GROUP BY ALL"
    )
    sql["catch_up_profile"] = f"SELECT * FROM ({_stored(week_events)}) s WHERE end_of_calculation_period BETWEEN DATE '2024-01-07' AND DATE '2024-01-21'"
    sql["profile_one_month"] = f"SELECT * FROM ({_stored(month)}) s WHERE end_of_calculation_period = DATE '1996-02-29'"
    day_events = _profile_sql("events", "ts", "day", rule="source")
    sql["profile_one_day"] = f"SELECT * FROM ({_stored(day_events)}) s WHERE end_of_calculation_period = DATE '2024-01-10'"
    twice = "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0)"
    sql["deviations_orders_dups"] = _deviations_sql(_profile_sql("orders", "o_orderdate", "month", dups=True, source=twice))
    sql["infinity_to_null"] = "SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN c_acctbal END AS value FROM customer"
    sql["parse_dates"] = (
        "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) "
        "WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '10 hours 20 minutes 30 seconds' END AS parsed FROM orders"
    )
    lims = " UNION ALL ".join(
        f"SELECT 'events' AS table_name, '{c}' AS column_name, "
        + ", ".join(f"CAST({'NULL' if m == 'sum_of_values' else 33.5} AS DECIMAL(19,2)) AS {m}_limit" for m in METRICS)
        + ", TIMESTAMP '2024-01-01' AS period_from_dttm"
        for c in ("event_id", "user_id", "value")
    )
    sql["limits_open"] = _deviations_sql(day_events, lims, v1=True)
    # update dates from the first day to the last day that have rows; the check date of each lies 3 days later
    checked = (
        "(SELECT * FROM events WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) + 3 FROM events WHERE CAST(ts AS DATE) <= (SELECT max(CAST(ts AS DATE)) FROM events)))"
    )
    sql["run_v1_days"] = _deviations_sql(_profile_sql("events", "ts", "day", rule="source", source=checked), v1=True)
    weeks_1 = f"SELECT * FROM ({_deviations_sql(week_events)}) w WHERE end_of_calculation_period <= DATE '2024-01-14'"
    weeks_2 = f"SELECT * FROM ({_deviations_sql(week_events)}) w WHERE end_of_calculation_period <= DATE '2024-01-28'"
    sql["run_checks"] = f"SELECT * FROM ({weeks_2}) e UNION ALL SELECT * FROM ({_deviations_sql(month)}) l"
    sql["run_checks_recovered"] = (
        "SELECT table_name, column_name, interval_type, end_of_calculation_period, CAST(1 AS BIGINT) AS in_metrics, CAST(1 AS BIGINT) AS in_statistics "
        f"FROM (SELECT * FROM ({weeks_1}) e UNION ALL SELECT * FROM ({_deviations_sql(month)}) l) r"
    )
    sql["profile_from_days"] = _stored(month)
    sql["profile_schedules"] = " UNION ALL ".join(_stored(_profile_sql("events", "ts", i, dups=True)) for i in ("day", "week", "month"))
    sql["profile_text_dates"] = (
        "SELECT * FROM (" + _stored(_profile_sql("lineitem", "l_shipdate", "month", source="(SELECT * FROM lineitem WHERE l_orderkey % 5 <> 2)"))
        + ") s WHERE end_of_calculation_period = DATE '1996-02-29'"
    )
    sql["deviations_week_scale6"] = _deviations_sql(_profile_sql("events", "ts", "week", scale6=True), scale6=True)
    sql["day_view"] = "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS report_date, * FROM events"
    sql["table_freshness"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, max({f}) AS last_value, max(CAST({f} AS DATE)) AS last_day FROM {t}" for t, f in DATED.items()
    )
    code = "CAST(CASE TABLE_NAME WHEN 'events' THEN 1 WHEN 'orders' THEN 2 ELSE 3 END AS BIGINT)"
    sql["fresh_tables"] = (
        f"WITH fl AS ({_first_last()}), s AS (SELECT TABLE_NAME AS TABLE_NM, first_day AS UPDATE_TABLE_DT, {code} AS INTERVAL_TERM, last_day FROM fl "
        f"UNION ALL SELECT TABLE_NAME, CAST(last_day + 1 AS DATE), {code}, last_day FROM fl) "
        "SELECT TABLE_NM, UPDATE_TABLE_DT, INTERVAL_TERM, last_day FROM s WHERE UPDATE_TABLE_DT <= last_day"
    )
    sql["slice_exists"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(g.day AS DATE) AS day, CAST(g.day AS DATE) IN (SELECT DISTINCT CAST({f} AS DATE) FROM {t}) AS has_rows "
        f"FROM (SELECT unnest(generate_series(min(CAST(CAST({f} AS DATE) AS TIMESTAMP)), max(CAST(CAST({f} AS DATE) AS TIMESTAMP)), INTERVAL 1 DAY)) AS day FROM {t}) g"
        for t, f in DATED.items()
    )
    present = " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS t, CAST({f} AS DATE) AS d FROM {t}" for t, f in DATED.items())
    sql["schedule_advance_v1"] = _v1_steps() + (
        f", pr AS ({present}), s AS (SELECT w.*, EXISTS (SELECT 1 FROM pr WHERE pr.t = w.TABLE_NM AND pr.d = w.u) AS has_rows FROM w WHERE u <= last_day) "
        "SELECT TABLE_NM, CAST(INTERVAL_TERM AS BIGINT) AS INTERVAL_TERM, CAST(step AS BIGINT) AS step, "
        "CASE WHEN has_rows THEN c END AS LAST_CHECK_DT, "
        "CAST(CASE INTERVAL_TERM WHEN 1 THEN c + 1 WHEN 2 THEN c + 7 ELSE c + CAST(day(last_day(c)) AS INTEGER) END AS DATE) AS NEXT_CHECK_DT, "
        "CAST(CASE INTERVAL_TERM WHEN 1 THEN u + 1 WHEN 2 THEN u + 7 ELSE u + CAST(day(last_day(u)) AS INTEGER) END AS DATE) AS UPDATE_TABLE_DT, "
        "has_rows FROM s"
    )
    return {**sql, **LLM_ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {})}
