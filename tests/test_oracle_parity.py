"""Every registered query with an oracle matches DuckDB on sf0.001 (values
compared after the shared 6-decimal rounding)."""

import pytest

from lodestar.plans.registry import load_all
from tests.conftest import SF_SMALL
from tools.oracle_check import norm_val

QUERIES, ORACLE = load_all()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    idx = {c: i for i, c in enumerate(ocols)}
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    a = sorted(tuple(norm_val(r[i]) for i in order) for r in rows)
    b = sorted(tuple(norm_val(r[idx[df.columns[i]]]) for i in order) for r in orows)
    assert a == b


def test_every_key_registered():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 79
