"""Every registered query of the library against its SQL in DuckDB."""

import glob
import os
import re

import pytest

from ringside import queries as Q
from tests.conftest import SF

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, tables, name):
    got = Q.QUERIES[name](spark, SF)
    want = tables.execute(Q.SQL[name])
    assert rows(got.columns, got.collect()) == rows([d[0] for d in want.description], want.fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_others_run(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


def test_norm_key_takes_every_document(spark, tables):
    def key(text):
        words = re.sub("[^a-z]+", " ", (text or "").lower()).split()
        return " ".join(w for w in words if w not in ("mr", "mrs", "ms", "dr", "miss"))

    texts = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    got = Q.QUERIES["norm_key"](spark, SF).collect()
    assert sorted((r.doc_id, r.key) for r in got) == sorted((d, key(t)) for d, t in texts)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_visual_lines_equal_sessions_without_drift(spark):
    words = spark.createDataFrame([("f", 1, i, f"w{i}", float(x), float(x + 5), t) for i, (x, t) in enumerate([(1, 10.0), (9, 10.4), (20, 12.9), (1, 13.1), (5, 40.0)])], "file string, page int, word_seq int, text string, x0 double, x1 double, top double")
    from ringside.operators import layout

    exact = {r.word_seq: r.line_no for r in layout.visual_lines(words).collect()}
    assert exact == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1}
    near = words.where("word_seq <> 3")
    assert {r.word_seq: r.line_no for r in layout.session_lines(near).collect()} == {0: 0, 1: 0, 2: 0, 4: 1}
