import numpy as np
import pandas as pd

from retentio.operators import curves as C


def test_cubic_closed_form_matches_polyfit():
    rng = np.random.default_rng(1)
    x = np.concatenate([[0.0], np.sort(rng.uniform(0, 1, 12))])
    y = 0.3 * x ** 3 - 0.2 * x ** 2 + 0.9 * x + 0.01 + rng.normal(0, 0.01, len(x))
    S = [float(np.sum(x ** k)) for k in range(7)]
    T = [float(np.sum(x ** k * y)) for k in range(4)]
    (a, b, c, d), det = C.cubic_from_sums(S, T)
    got = np.array([a, b, c, d]) / det
    assert np.allclose(got, np.polyfit(x, y, 3), atol=1e-8)


def test_curve_fit_against_grouped_polyfit(spark):  # D32, T22
    rng = np.random.default_rng(2)
    rows = []
    for country, n in (("A", 20), ("B", 6), ("C", 2)):
        xs = np.sort(rng.uniform(0.05, 1, n))
        for x in xs:
            rows.append((country, "2021-05", float(x), float(0.5 * x ** 3 + 0.2 * x + rng.normal(0, 0.01))))
    curve = spark.createDataFrame(pd.DataFrame(rows, columns=["Country", "Month", "%Month", "%M1"]))
    fit = {r.Country: r for r in C.curve_fit_cubic(curve).collect()}

    def polyfit(pdf):
        x = np.concatenate([[0.0], pdf["%Month"].to_numpy()])
        y = np.concatenate([[0.0], pdf["%M1"].to_numpy()])
        a, b, c, d = np.polyfit(x, y, 3)
        return pd.DataFrame([{"Country": pdf["Country"].iloc[0], "A": a, "B": b, "C": c, "D": d}])

    ref = {r.Country: r for r in curve.filter("Country != 'C'").groupBy("Country")
           .applyInPandas(polyfit, "Country string, A double, B double, C double, D double").collect()}
    for k in ("A", "B"):
        for col in "ABCD":
            assert abs(fit[k][col] - ref[k][col]) < 1e-6
    assert fit["C"]["A"] is None   # fewer than four distinct points: no fit
