"""Property: distributed percentile ranks equal pandas' average-tie ranks."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from boxstar.operators import percentile_rank_by, value_ranks  # noqa: F401

values = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(-5, 5).map(float))),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=values, asc=st.booleans())
def test_percentile_rank_property(spark, rows, asc):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["v"]): r["p"] for r in percentile_rank_by(df, ["g"], "v", asc, "p", parts=3).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    pdf["p"] = pdf.groupby("g")["v"].rank(pct=True, method="average", ascending=asc) * 100
    for g, v, p in pdf.itertuples(index=False):
        if v is None or (isinstance(v, float) and np.isnan(v)):
            continue
        assert abs(got[(g, v)] - p) < 1e-9
