"""The operators' SQL against the operators, on the odd cases and on empty tables."""

import math

import duckdb
import pytest

from tests.llm.helpers import corpus, frame
from tidemark.llm import queries

BENCHMARK = [
    (1, "The river, the stone; the light walks under over house of and the river"),
    (2, "One"),
    (10, "le été où garçon mange très la forêt Noël jardin le été"),
    (11, None),
    (None, "x y z x y z x y z x y"),
]


def compared(df, con, sql):
    """Both sides' rows by column name, floats to twelve digits."""
    found = con.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    clean = lambda v: float(f"{v:.12g}") if isinstance(v, float) and not math.isnan(v) else v
    ours = sorted((tuple(clean(r[n]) for n in names) for r in df.collect()), key=repr)
    place = [found.columns.index(n) for n in names]
    theirs = sorted((tuple(clean(r[i]) for i in place) for r in found.fetchall()), key=repr)
    return ours, theirs


def lines():
    """Texts whose lines break each of the rules, and lines that just keep them."""
    body = " ".join(f"word{i}" for i in range(60))
    odd = ["# $ % word", "a | b | c | d | e", "so!!!!!!!!!! loud", "Read MORE here", "go " * 10, "go " * 9 + "stop", "same line", "same line", "Menu", "One sentence.", 'He said "so."  ', "Mehr erfahren!", "Umweiterlesens.", "ไทยไม่มีจุด", "Tous droits réservés.", "Привет мир", "«Leer más.»", "bread more.", "it's conditions d'utilisation now.", "» a › b • c · d"]
    rows = [(5000 + i, body + "\n" + x, "en", "s0", 1) for i, x in enumerate(odd)]
    return rows + [(5100, "\n".join(odd * 3) + "\n" + body, "en", None, 1), (5101, (body + "\n") * 2 + "go " * 200, "fr", "s1", 1)]


@pytest.mark.parametrize("empty", [False, True])
def test_sql_says_the_same(spark, tmp_path, empty):
    rows = [] if empty else corpus() + lines()
    frame(spark, rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([] if empty else BENCHMARK, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    for name, sql in queries.oracle_sql().items():
        ours, theirs = compared(queries.queries()[name](spark, str(tmp_path)), con, sql)
        assert ours == theirs, name
        assert len(ours) == len(rows)
