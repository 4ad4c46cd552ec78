"""The covariance estimate of the quality rules against a plain search from many random starts."""

import numpy as np
from pyspark.sql import functions as F

from strider.llm import quality_rules as qr

SHARE = 0.75


def search(x: np.ndarray, floor: np.ndarray, tries: int = 60) -> float:
    """The least log determinant of the floored covariance over C-steps from random five-row starts."""
    rng, h, best = np.random.default_rng(5), int(np.ceil(SHARE * len(x))), np.inf
    for _ in range(tries):
        part = x[rng.choice(len(x), 5, replace=False)]
        for _ in range(40):
            mu, cov = part.mean(0), np.cov(part.T, bias=True) + floor
            part = x[np.argsort(np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(cov), x - mu), kind="stable")[:h]]
        best = min(best, np.linalg.slogdet(np.cov(part.T, bias=True) + floor)[1])
    return best


def sample(n: int, far: int) -> np.ndarray:
    rng = np.random.default_rng(n)
    mix = np.array([[900, 0, 0, 0], [500, 700, 0, 0], [0, 200, 400, 0], [100, 0, 50, 300]])
    x = rng.normal(size=(n, 4)) @ mix.T + [5000, 6000, 900, 400]
    x[:far] = rng.normal(size=(far, 4)) * 150 + [9000, 1000, 4000, 2500]
    return np.round(x).astype(int)


def frame(spark, groups: dict[str, np.ndarray]):
    rows = [(f"{s}{i}", "en", s, True, *map(int, v)) for s, x in groups.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id string, lang string, source string, fit boolean, " + ", ".join(f"{f} long" for f in qr.FEATURES))


def test_least_determinant_and_outliers(spark):
    groups = {"a": sample(400, 80), "b": sample(150, 0)}
    df = frame(spark, groups)
    fits = qr.mcd(df.select(F.col("source").alias("g"), *qr.FEATURES), F.broadcast, SHARE).collect()
    floor = np.diag(np.square(qr.FLOOR))
    assert len(fits) == 2
    for r in fits:
        assert r.logdet <= search(groups[r.g].astype(float), floor) + 0.1
    out = {r.id: r.outlier for r in qr.outliers(qr.stage(df, "rows")).collect()}
    assert all(out[f"a{i}"] for i in range(80))
    assert sum(out[f"a{i}"] for i in range(80, 400)) <= 4 and sum(out[f"b{i}"] for i in range(150)) <= 3


def test_small_and_equal_groups_have_a_verdict(spark):
    same = np.repeat([[5000, 6000, 900, 400]], 12, 0)
    same[0] = [5000, 6000, 900, 40_000]
    out = {r.id: (r.outlier, r.distance2) for r in qr.outliers(qr.stage(frame(spark, {"c": same}), "rows")).collect()}
    assert out["c0"][0] and not any(out[f"c{i}"][0] for i in range(1, 12)) and all(d is not None for _, d in out.values())


def test_constants():
    assert abs(qr.chi_quantile(0.975) - qr.CHI_NEAR) < 1e-2 and abs(qr.chi_quantile(0.999) - qr.CHI_CUT) < 1e-2
    assert abs(qr.consistency(0.75, qr.chi_quantile(0.75)) - 1.4865) < 1e-3
