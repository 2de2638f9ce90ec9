"""Every catalogue query with SQL against DuckDB, and the driver's entry points."""

import duckdb
import pytest

import __spark_entry__ as entry
from linemend.plans import catalog

SQL = catalog.oracle_sql()
#: Independent of the rows: names, and the queries that have SQL.
PROPERTIES = sorted(set(catalog.queries()) - set(SQL))


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple("%.9g" % r[i] if isinstance(r[i], float) else r[i] for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names) and got == want


def test_verdicts_cover_all_breaks(spark, sf_dir):
    q = catalog.queries()
    total = sum(r.occurrences for r in q["verdict_totals"](spark, sf_dir).collect())
    assert total == q["break_pairs"](spark, sf_dir).count()


def test_paragraph_records(spark, sf_dir):
    out = catalog.queries()["ocr_paragraph_diff"](spark, sf_dir).collect()
    assert out and {r.outcome for r in out} <= {"applied", "join-artifact", "straddles-break", "changes-break"}
    assert all((r.pos is None) == (r.outcome != "applied") for r in out)
    fixes = catalog.queries()["positional_fixes"](spark, sf_dir).collect()
    assert fixes and all(r.before != r.after for r in fixes)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
