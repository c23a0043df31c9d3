"""The lognormal curve and its fit against plain sums over a sampled snow distribution."""

from statistics import NormalDist

import numpy as np
import pytest

from tarnworks.operators import snow

NORMAL = np.array([NormalDist().inv_cdf((i + 0.5) / 100_000) for i in range(100_000)])


def plain_curve(cv):
    """Melts 100,000 equal shares of a basin, of mean depth 1, by the same depth until nothing is left."""
    z = np.sqrt(np.log1p(cv * cv))
    depth = np.sort(np.exp(z * NORMAL - z * z / 2))
    depth /= depth.mean()
    after = (depth.sum() - np.cumsum(depth) - depth * (len(depth) - 1 - np.arange(len(depth)))) / len(depth)  # snow left when a share melts out
    cover = 1 - (np.arange(len(depth)) + 1) / len(depth)
    return np.interp([1 - i / 10 for i in range(11)], after[::-1], cover[::-1])


@pytest.mark.parametrize("cv", [0.1, 0.4, 0.8, 1.2])
def test_lognormal_curve_is_a_melted_distribution(cv):
    got = snow.lognormal_curve(np.array([cv]))[0]
    assert got[0] == 1.0 and got[-1] == 0.0
    assert np.abs(got[1:-1] - plain_curve(cv)[1:-1]).max() < 2e-3


def test_curves_of_null_and_equal_coefficients(spark):
    rows = spark.createDataFrame([(1, 0.4), (2, None), (3, 0.4), (4, 0.0)], "k long, cv double")
    got = {r.k: r.curve for r in snow.lognormal_curves(rows).collect()}
    assert got[2] is None and got[1] == got[3]
    assert min(got[4][:-1]) > 0.99  # no variation: all melts out at once


def test_library_pipeline_by_source(spark):
    """Own curves fit their coefficient; zones with no coefficient at all get curve 1."""
    curves = snow.lognormal_curve(np.array([0.3, 0.6, 0.9, 1.2]))
    rows = [(i + 1, "derived", "mid", 0.05, 3, 2, 254.0, None, [float(x) for x in c]) for i, c in enumerate(curves)]
    rows += [(9, "default_no_snow", "mid", None, 0, 0, None, None, [1 - i / 10 for i in range(11)]), (10, "default_low_sca", "low", None, 0, 1, -1.0, 0.61, [1 - i / 10 for i in range(11)])]
    records = spark.createDataFrame(rows, "zone_id long, sdc_status string, sca_class string, similarity double, n_seasons long, n_peak_years long, peak_swe_mm double, cv_subgrid double, curve array<double>")
    library, out, report = snow.library_pipeline(records, 2, [1 - i / 10 for i in range(11)])
    got = {r.zone_id: (r.hru_deplcrv, r.cv_source, r.cv_assign, r.snarea_thresh) for r in out.collect()}
    assert not report["calibrated"]
    assert got == {1: (2, "empirical", 0.3, 10.0), 2: (2, "empirical", 0.6, 10.0), 3: (3, "empirical", 0.9, 10.0), 4: (3, "empirical", 1.2, 10.0), 9: (1, "default_no_snow", None, 0.0), 10: (2, "subgrid", 0.61, 0.0)}
    assert [(r.deplcrv_id, r.curve_kind, r.cv) for r in library.orderBy("deplcrv_id").collect()] == [(1, "default", None), (2, "cv_bin", pytest.approx(0.6)), (3, "cv_bin", pytest.approx(1.05))]
