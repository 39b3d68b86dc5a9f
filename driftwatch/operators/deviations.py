"""V3: deviations of a profile from its previous snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_LIMIT_PCT, METRICS, STORE_DECIMAL, TEMPLATES_RU, TEMPLATES_RU_V1, V1_MISSING_PREVIOUS_DATE
from ..functions.deltas import exceeds, pct_delta, python_number_text, python_round_2
from ..schemas import METRICS_TABLE
from .history import join_previous
from .limits import apply_limits, limits_open
from .versions import open_versions


def _text(template: str, metric: str, delta: Column | None = None) -> Column:
    head, _, tail = template.replace("{m}", metric).partition("{d}")
    if delta is None or not _:
        return F.lit(template.replace("{m}", metric))
    return F.concat(F.lit(head), python_number_text(delta), F.lit(tail))


def _deviation_frame(
    current: DataFrame,
    history: DataFrame | None,
    limits: DataFrame | None,
    templates: dict,
    default_limit,
    null_prev_zero_cur: float | None,
    store_scale: int = 2,
    identities: DataFrame | None = None,
) -> DataFrame:
    """All deviation columns (deltas, flags, text) next to the joined rows."""
    rows = apply_limits(join_previous(current, history, store_scale, identities), limits, default_limit)
    zero, tmpl_delta, dup_text, sep = templates["zero"], templates["delta"], templates["duplicates"], templates["sep"]
    out = rows
    parts, flags = [], []
    for m in METRICS:
        cur, prev = F.col(m).cast("double"), F.col(f"prev_{m}")
        delta = pct_delta(cur, prev, null_prev_zero_cur=null_prev_zero_cur)
        out = out.withColumn(f"delta_{m}", delta)
        flag = exceeds(F.col(f"delta_{m}"), F.col(f"{m}_limit"))
        out = out.withColumn(f"__f_{m}", flag)
        flags.append(F.col(f"__f_{m}"))
        cur_d, prev_d = F.col(m).cast("double"), F.col(f"prev_{m}")
        unmeasurable = ((cur_d == 0) | (prev_d == 0)) & ~cur_d.eqNullSafe(prev_d)
        text = F.when(unmeasurable, _text(zero, m)).otherwise(_text(tmpl_delta, m, F.col(f"delta_{m}")))
        parts.append(F.when(F.col(f"__f_{m}"), text))
    dup_flag = F.coalesce(F.col("dublicates_cnt") > 0, F.lit(False))
    flags.append(dup_flag)
    parts.append(F.when(dup_flag, F.lit(dup_text)))
    any_flag = flags[0]
    for f in flags[1:]:
        any_flag = any_flag | f
    return out.withColumn("deviation_flg", any_flag.cast("int")).withColumn("deviation_desc", F.concat_ws(sep, *parts))


def _metrics_columns(out: DataFrame, stamp: dt.datetime) -> list:
    cols = []
    for f in METRICS_TABLE.fields:
        if f.name == "report_dttm":
            c = F.lit(stamp).cast("timestamp")
        elif f.name.startswith("delta_"):
            c = F.col(f.name).try_cast(STORE_DECIMAL)
        elif f.name in METRICS and not f.name.endswith("_cnt"):
            c = python_round_2(F.col(f.name)).try_cast(STORE_DECIMAL)
        else:
            c = F.col(f.name).cast(f.dataType)
        cols.append(c.alias(f.name))
    return cols


def deviations(
    current: DataFrame,
    history: DataFrame | None = None,
    limits: DataFrame | None = None,
    *,
    report_dttm: dt.datetime | None = None,
    templates: dict = TEMPLATES_RU,
    default_limit=DEFAULT_LIMIT_PCT,
    null_prev_zero_cur: float | None = None,
    store_scale: int = 2,
    identities: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``dq_metrics`` for every row of ``current`` (any number of periods).

    ``current``: working-precision profile rows.  ``history``: stored
    ``dq_table_statistics`` rows (may be empty).  ``limits``: rows of
    ``dq_deviations_setup`` (may be None).  ``store_scale``: decimal places of
    stored values (M5; with 6 an unchanged small mean is no deviation).  ``identities``: a map of
    columns across schema versions, see ``join_previous``.  A lazy plan over ``current``; no collect.
    """
    out = _deviation_frame(current, history, limits, templates, default_limit, null_prev_zero_cur, store_scale, identities)
    return out.select(*_metrics_columns(out, report_dttm or dt.datetime.now()))


def deviations_v1(
    current: DataFrame,
    history: DataFrame | None = None,
    limits: DataFrame | None = None,
    *,
    report_dttm: dt.datetime | None = None,
    templates: dict = TEMPLATES_RU_V1,
    default_limit=DEFAULT_LIMIT_PCT,
    comparison_default: dt.date = V1_MISSING_PREVIOUS_DATE,
) -> DataFrame:
    """The v1 result rows: M2 null rule, v1 wording, ``comparison_dt`` (N6) and
    an open version (V2: valid from ``report_dttm`` + 1 s to 2100-01-01)."""
    stamp = report_dttm or dt.datetime.now()
    if limits is not None and "period_to_dt" in limits.columns:  # versions; the open one counts
        limits = limits_open(limits).withColumn("period_from_dttm", F.lit(None).cast("timestamp"))
    out = _deviation_frame(current, history, limits, templates, default_limit, 100.0)
    cols = _metrics_columns(out, stamp) + [
        F.coalesce(F.col("prev_end"), F.lit(comparison_default).cast("date")).alias("comparison_dt"),
    ]
    return open_versions(out.select(*cols), stamp)
