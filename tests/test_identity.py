import datetime as dt

from driftwatch.operators.deviations import deviations
from driftwatch.operators.history import join_previous
from driftwatch.operators.identity import IDENTITIES, column_identities, rename_column
from driftwatch.schemas import STATISTICS

from test_deviations import _stats_row

D = dt.date
STAMP = dt.datetime(2024, 3, 1)
OPEN = D(2100, 1, 1)


def _profile(spark, *rows):
    """(column, id, end, rows_cnt) as stored rows."""
    out = []
    for column, cid, end, n in rows:
        row = dict(zip([f.name for f in STATISTICS.fields], _stats_row(end, STAMP, column, rows_cnt=n)))
        row["column_id"] = cid
        out.append(tuple(row[f.name] for f in STATISTICS.fields))
    return spark.createDataFrame(out, STATISTICS)


def _map(df):
    return sorted((r.column_name, r.identity, r.period_from, r.period_to) for r in df.collect())


def test_added_column_keeps_previous_values(spark):
    hist = _profile(spark, ("b", 0, D(2024, 1, 1), 10), ("c", 1, D(2024, 1, 1), 20))
    cur = _profile(spark, ("a", 0, D(2024, 1, 2), 5), ("b", 1, D(2024, 1, 2), 10), ("c", 2, D(2024, 1, 2), 30))
    by_id = {r.column_name: r.prev_rows_cnt for r in join_previous(cur, hist).collect()}
    assert by_id == {"a": None, "b": None, "c": None}  # the default rule: every id has moved
    ids = column_identities(cur, column_identities(hist))
    assert _map(ids) == [("a", 3, D(2024, 1, 2), OPEN), ("b", 1, D(2024, 1, 1), OPEN), ("c", 2, D(2024, 1, 1), OPEN)]
    joined = join_previous(cur, hist, identities=ids)
    assert {r.column_name: r.prev_rows_cnt for r in joined.collect()} == {"a": None, "b": 10.0, "c": 20.0}
    assert joined.columns == join_previous(cur, hist).columns
    flags = {r.column_name: r.deviation_flg for r in deviations(cur, hist, None, report_dttm=STAMP, identities=ids).collect()}
    assert flags == {"a": 0, "b": 0, "c": 1}


def test_rename_reuse_and_backfill(spark):
    one = column_identities(_profile(spark, ("a", 0, D(2024, 1, 5), 1), ("b", 1, D(2024, 1, 5), 1)))
    renamed = rename_column(one, "t", "a", "z", D(2024, 1, 10))
    assert _map(renamed) == [("a", 1, D(2024, 1, 5), D(2024, 1, 9)), ("b", 2, D(2024, 1, 5), OPEN), ("z", 1, D(2024, 1, 10), OPEN)]
    # the old name comes back as another column; b is seen before its first period
    later = _profile(spark, ("a", 0, D(2024, 1, 12), 1), ("z", 1, D(2024, 1, 12), 1), ("b", 2, D(2024, 1, 1), 1))
    ids = column_identities(later, renamed)
    assert _map(ids) == [
        ("a", 1, D(2024, 1, 5), D(2024, 1, 9)), ("a", 3, D(2024, 1, 12), OPEN), ("b", 2, D(2024, 1, 1), OPEN), ("z", 1, D(2024, 1, 10), OPEN),
    ]
    assert _map(column_identities(later, ids)) == _map(ids)  # nothing new: the same map
    # a rename declared after the new name was seen takes its identity back; unknown names change nothing
    late = rename_column(column_identities(_profile(spark, ("y", 0, D(2024, 1, 11), 1)), one), "t", "b", "y", D(2024, 1, 11))
    assert _map(late) == [("a", 1, D(2024, 1, 5), OPEN), ("b", 2, D(2024, 1, 5), D(2024, 1, 10)), ("y", 2, D(2024, 1, 11), OPEN)]
    assert _map(rename_column(one, "t", "q", "a", D(2024, 1, 11))) == _map(one) == _map(rename_column(one, "u", "a", "b", D(2024, 1, 11)))


def test_empty_and_whole_table(spark):
    assert column_identities(spark.createDataFrame([], STATISTICS)).count() == 0
    whole = _profile(spark, ("a", 0, None, 7))
    ids = column_identities(whole)
    assert _map(ids) == [("a", 1, STAMP.date(), OPEN)]
    none = spark.createDataFrame([], IDENTITIES)
    hist = _profile(spark, ("a", 0, D(2024, 1, 1), 7))
    cur = _profile(spark, ("a", 0, D(2024, 1, 2), 7))
    assert [r.prev_rows_cnt for r in join_previous(cur, hist, identities=none).collect()] == [None]
