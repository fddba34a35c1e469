"""Every table query against its SQL, on the smallest test tables."""

import json
import math
from pathlib import Path

import duckdb
import pytest

from tidemark.operators.stats import file_stats
from tidemark.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


@pytest.mark.skipif(not Path(DATA).exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, database, name):
    df = queries.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    ours = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    assert ours or name in ("q_prune_files", "q_iso")
    if name in queries.SQL:
        found = database.sql(queries.SQL[name])
        assert names == sorted(found.columns)
        place = [found.columns.index(n) for n in names]
        theirs = [tuple(plain(r[i]) for i in place) for r in found.fetchall()]
        assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def check_on_events(spark, folder, name, ids):
    """The query against its SQL on events of these numbers."""
    spark.createDataFrame([(i,) for i in ids], "event_id long").coalesce(1).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    found = con.sql(queries.SQL[name])
    ours = [tuple(r) for r in queries.QUERIES[name](spark, str(folder)).select(*found.columns).collect()]
    assert sorted(ours, key=repr) == sorted(found.fetchall(), key=repr)


def test_dates_beyond_four_digits_equal_the_sql(spark, tmp_path):
    """The last day of year 9999 and the first of 10000, years before 0, and no number."""
    check_on_events(spark, tmp_path, "q_dates", [0, 980_631, 980_632, 980_633, 5_999_999, -5, -236_843, -236_844, -300_000, None])


def test_times_beyond_four_digits_equal_the_sql(spark, tmp_path):
    """The last time of year 9999 and the first of 10000, years of six digits, years before 0, and no number."""
    check_on_events(spark, tmp_path, "q_iso", [0, 36_105, 36_106, 99_999, 131_000, 599_999, 1_200_000, -5_130, -6_000, -300_000, -1_000_000, None])


def test_a_bound_that_is_null_is_left_out(spark):
    """A column of times that are all null: its bounds were the text nullTnull:null:null.nullZ."""
    df = spark.createDataFrame([(1, None), (2, None)], "k int, at timestamp")
    own = json.loads(file_stats(df, []).first()["stats"])
    assert own == {"numRecords": 2, "minValues": {"k": 1}, "maxValues": {"k": 2}, "nullCount": {"k": 0, "at": 2}}
