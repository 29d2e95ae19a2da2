"""Features written as pandas code (F1 ``kind="pandas"``, F7 group apply).

They exist for logic that built-in expressions cannot state; the catalogue
itself is native.  Both run Arrow-batched: a pandas Series per batch, or one
pandas frame per (bounded) group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from .registry import feature


@feature("grade_level_slug", str, stage="post", kind="pandas", inputs=("GradeLevel",))
def grade_level_slug(grades: pd.Series) -> pd.Series:
    """Grade level as an ASCII key: accents taken off (Unicode decomposition,
    which no built-in function has), lower case, other runs as one hyphen."""
    plain = grades.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
    return plain.str.lower().str.replace("[^a-z0-9]+", "-", regex=True).str.strip("-")


def period_slope(pdf: pd.DataFrame) -> dict:
    """OLS slope of ``value`` over the group's periods in order (0.0 with
    fewer than two), one output row per group."""
    order = np.argsort(pdf["period"].to_numpy(), kind="stable")
    y = pdf["value"].to_numpy(dtype=float)[order]
    n = len(y)
    if n < 2:
        slope = 0.0
    else:
        i = np.arange(n, dtype=float)
        slope = float(((i - i.mean()) * (y - y.mean())).sum() / ((i - i.mean()) ** 2).sum())
    return {"entity": pdf["entity"].iat[0], "n_periods": n, "value_slope": slope}
