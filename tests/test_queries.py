"""Registered queries against their SQL restatement on the smallest tables.

All of them run with ``MOORSPARK_ALL_QUERIES=1``; by default one per family.
"""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAMILY = ["a1_read_text_records", "b10_dataset_attributes", "c4_regularise", "c5_null_intervals", "d4_around_boundary", "e2_timing_report", "e5_normalise", "f5_change_point",
          "f15_fill_short_gaps", "g6_find_deployment", "h3_timing_offsets", "h6_best_lag", "i4_interpolate_extrapolate", "i6_stack_levels", "j4_combined_qc", "j12_flat_line",
          "k4_pressure_drift", "l10_full_profiles_inner", "m3_site_priority", "n2_sigma0", "o2_stream_means"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(v):
    if v is None:
        return "~"
    return repr(v) if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("MOORSPARK_ALL_QUERIES") else FAMILY)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    exp = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == exp


def test_every_query_is_named_after_its_operator():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q)
    ids = {n.split("_")[0] for n in q if not n.startswith("op") and n != "pipeline"}
    expected = ({f"a{i}" for i in (1, 2, 3, 4, 5, 8, 9, 10, 11)} | {f"b{i}" for i in range(1, 24) if i != 12} | {f"c{i}" for i in range(1, 11)}
                | {f"d{i}" for i in range(1, 9)} | {f"e{i}" for i in range(1, 15) if i != 7} | {f"f{i}" for i in range(1, 16) if i != 11} | {f"g{i}" for i in range(1, 10)}
                | {f"h{i}" for i in range(1, 9)} | {f"i{i}" for i in range(1, 10)} | {f"j{i}" for i in range(1, 19)} | {f"k{i}" for i in range(1, 7)}
                | {f"l{i}" for i in range(1, 15)} | {f"m{i}" for i in range(1, 7)} | {"n1", "n2", "n3", "o1", "o2", "p1", "p2", "p3"})
    assert ids == expected
