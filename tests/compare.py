"""Order-insensitive comparison of two tables, floats to nine decimals."""

import math

import numpy as np
import pandas as pd


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool | np.bool_):
        return str(bool(x))
    if isinstance(x, float | np.floating):
        return repr(round(float(x), 9) + 0.0)
    if isinstance(x, int | np.integer):
        return str(int(x))
    return str(x)


def rows(df):
    columns = sorted(df.columns)
    out = df[columns].astype(object).map(_cell)
    for c in columns:  # an integer column with nulls is a float one in pandas
        if df[c].dtype.kind == "f" and (df[c].dropna() == df[c].dropna().round()).all():
            out[c] = [s.removesuffix(".0") for s in out[c]]
    return columns, sorted(map(tuple, out.itertuples(index=False)))


def same(a, b):
    (ca, ra), (cb, rb) = rows(a), rows(b)
    assert ca == cb
    assert len(ra) == len(rb)
    assert ra == rb
