"""Month-cluster bootstrap and masked prediction against numpy on the rows themselves."""

import numpy as np
import pytest

from weftline.operators import factor_checks, matrices


@pytest.fixture(scope="module")
def data():
    """Six measures of two factors, in twelve months whose mix of factors drifts."""
    rng = np.random.default_rng(8)
    month = rng.integers(0, 12, 1500)
    factors = rng.normal(size=(1500, 2)) * np.stack([1 + month / 12, 2 - month / 12], 1)
    loadings = np.array([[0.9, 0], [0.8, 0.1], [0.7, 0], [0, 0.9], [0.1, 0.8], [0, 0.6]])
    return month, factors @ loadings.T + rng.normal(size=(1500, 6)) * 0.4


@pytest.fixture(scope="module")
def frame(spark, data):
    month, x = data
    rows = [(f"2020-{m + 1:02d}", int(m // 3), v.tolist()) for m, v in zip(month, x, strict=True)]
    return spark.createDataFrame([*rows, (None, None, x[0].tolist()), ("2020-01", 0, None), ("2020-01", 0, [1.0, None, 1.0, 1.0, 1.0, 1.0])], "month string, fold int, v array<double>").repartition(5)


def plain_fit(x, factors, shrink):
    r = (1 - shrink) * np.corrcoef(x, rowvar=False) + shrink * np.eye(x.shape[1])
    pattern, _ = matrices.promax(matrices.principal_axes(r, factors)[0])
    return pattern * np.sign(pattern.sum(0))


def test_bootstrap_against_resampled_rows(frame, data):
    month, x = data
    full = plain_fit(x, 2, 0.02)
    refits = []
    for r in range(60):
        counts = factor_checks.draw(5, r, 12)
        pattern = plain_fit(np.concatenate([np.repeat(x[month == m], counts[m], axis=0) for m in range(12)]), 2, 0.02)
        best = max(([pattern[:, o] * s for o in ([0, 1], [1, 0]) for s in ([1, 1], [1, -1], [-1, 1], [-1, -1])]), key=lambda p: (p * full).sum())
        refits.append(best)
    low, high = np.percentile(refits, [2.5, 97.5], axis=0)
    found = factor_checks.bootstrap(frame, "month", "v", 2, replicates=60, seed=5).collect()
    assert len(found) == 12 and {r.refits for r in found} == {60}
    for r in found:
        at = r.variable, r.factor
        assert (r.loading, r.low, r.high) == pytest.approx((full[at], low[at], high[at]), abs=1e-6)
    assert all(r.low <= r.loading <= r.high for r in found)


def test_replicates_without_variation_are_left_out(spark):
    rng = np.random.default_rng(1)
    rows = [("a", [1.0, float(v), float(v + rng.normal())]) for v in rng.normal(size=50)] + [("b", [float(u), float(v), float(v + rng.normal())]) for u, v in rng.normal(size=(50, 2))]
    found = factor_checks.bootstrap(spark.createDataFrame(rows, "month string, v array<double>"), "month", "v", 1, replicates=40).collect()
    left_out = sum(factor_checks.draw(1, r, 2)[1] == 0 for r in range(40))
    assert 0 < left_out and {r.refits for r in found} == {40 - left_out}


def test_alignment_undoes_order_and_sign():
    rng = np.random.default_rng(2)
    for k in (2, 5, 8):
        to = np.linalg.qr(rng.normal(size=(12, k)))[0]
        mixed = to[:, rng.permutation(k)] * rng.choice([-1, 1], k)
        assert np.allclose(factor_checks.aligned(mixed, to), to)


def test_masked_prediction_against_rows(frame, data):
    month, x = data
    fold = month // 3
    found = {(r.fold, r.variable): r for r in factor_checks.masked_prediction(frame, "fold", "v").collect()}
    assert len(found) == 3 * 6
    for f in (1, 2, 3):
        train, test = x[fold < f], x[fold == f]
        mean, cov = train.mean(0), np.cov(train, rowvar=False)
        cov = 0.98 * cov + 0.02 * np.diag(np.diag(cov))
        for j in range(6):
            o = [i for i in range(6) if i != j]
            guess = mean[j] + (test[:, o] - mean[o]) @ np.linalg.solve(cov[np.ix_(o, o)], cov[o, j])
            r = found[f, j]
            assert (r.trained, r.n) == (len(train), len(test))
            assert r.rmse == pytest.approx(np.sqrt(((test[:, j] - guess) ** 2).mean()))
            assert r.mean_rmse == pytest.approx(np.sqrt(((test[:, j] - mean[j]) ** 2).mean()))
            assert r.rmse < r.mean_rmse


def test_no_fold_sees_later_rows(frame):
    early = factor_checks.masked_prediction(frame.where("fold <= 1"), "fold", "v").collect()
    late = {(r.fold, r.variable): r.rmse for r in factor_checks.masked_prediction(frame, "fold", "v").collect()}
    assert early and all(late[r.fold, r.variable] == pytest.approx(r.rmse, rel=1e-12) for r in early)
    assert factor_checks.masked_prediction(frame.where("fold = 2"), "fold", "v").count() == 0
