"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest scale factor."""

import os
import sys

import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from crewload import params as P  # noqa: E402
from crewload.plans import registry  # noqa: E402
from compare import compare  # noqa: E402

NAMES = sorted(registry.build(P.DEFAULT))


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["PAIRING_DATE", "BASE", "RLV", "ASN", "perc_utl"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "ok", res
