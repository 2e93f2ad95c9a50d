"""Every registered query beside its DuckDB twin, on the smallest tables."""

from __future__ import annotations

from datetime import date

import pandas as pd
import pytest

from shockline.plans import registry

from .conftest import SF


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith("datetime"):
            df[c] = (s.dt.tz_localize(None) if s.dt.tz is not None else s).astype("datetime64[us]").map(lambda x: "none" if pd.isna(x) else str(x)).astype(object)
        elif s.dtype.kind == "f":
            df[c] = s.map(lambda x: "none" if x != x else f"{x:.9g}")
        else:
            df[c] = s.map(lambda x: "none" if pd.isna(x) else str(x) + " 00:00:00" * (type(x) is date))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = plain(got), plain(want)
    assert len(got) == len(want)
    assert got.equals(want), got[(got != want).any(axis=1)].head()


def test_every_query_has_a_twin_or_a_golden_test():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
