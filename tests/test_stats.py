"""Distribution helpers against table values, and the tests on hand-sized groups."""

import math
from decimal import Decimal

import pytest

from carelens.functions.distributions import betainc, f_survival, t_quantile, t_two_sided_p
from carelens.operators import statistics as st


def test_t_table_values():
    assert abs(t_quantile(0.975, 10) - 2.228138851986) < 1e-9
    assert abs(t_quantile(0.975, 1) - 12.706204736175) < 1e-8
    assert abs(t_two_sided_p(2.228138851986, 10) - 0.05) < 1e-10
    assert abs(t_two_sided_p(1.959963984540, 1e9) - 0.05) < 1e-8
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)


def test_f_and_beta_values():
    assert abs(f_survival(2.3719, 4, 59995) - 0.05) < 1e-4
    assert abs(f_survival(4.964603, 1, 10) - 0.05) < 1e-6
    assert abs(betainc(2, 3, 0.4) - 0.5248) < 1e-12
    assert betainc(2, 3, 0.0) == 0.0 and betainc(2, 3, 1.0) == 1.0


def _claims(spark, groups):
    rows = [(g, Decimal(str(v))) for g, vals in groups.items() for v in vals]
    return spark.createDataFrame(rows, "InsuranceProvider string, BillingAmount decimal(18,4)")


def test_welch_and_cohens_d_by_hand(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    m = st.group_moments(_claims(spark, {"A": a, "B": b}))
    w = st.welch(m).collect()[0]
    ma, mb = sum(a) / 4, sum(b) / 5
    va = sum((x - ma) ** 2 for x in a) / 3
    vb = sum((x - mb) ** 2 for x in b) / 4
    t = (ma - mb) / math.sqrt(va / 4 + vb / 5)
    df = (va / 4 + vb / 5) ** 2 / ((va / 4) ** 2 / 3 + (vb / 5) ** 2 / 4)
    assert (w.provider_a, w.provider_b) == ("A", "B")
    assert w.t_stat == round(t, 4) and w.df == round(df, 2)
    assert w.p_value == round(t_two_sided_p(t, df), 6)
    d = st.cohens_d(m).collect()[0]
    assert d.cohens_d == round((ma - mb) / math.sqrt((va + vb) / 2), 4) and d.effect == "LARGE"


def test_pairs_count_and_single_group(spark):
    m = st.group_moments(_claims(spark, {k: [1.0, 2.0, 3.0] for k in "ABCDE"}))
    assert st.pairs(m).count() == 10
    one = st.group_moments(_claims(spark, {"A": [5.0]}))
    assert st.welch(one).count() == 0  # fewer than two groups: no pairs
    rep = st.moments_report(one).collect()[0]
    assert rep.n == 1 and rep.stddev == 0.0


def test_anova_by_hand(spark):
    groups = {"A": [1.0, 2.0, 3.0], "B": [2.0, 3.0, 4.0], "C": [5.0, 6.0, 7.0]}
    r = st.anova(st.group_moments(_claims(spark, groups))).collect()[0]
    # grand mean 3.6667; SSB = 3*(2-3.667)^2 + 3*(3-3.667)^2 + 3*(6-3.667)^2 = 26; SSW = 6
    assert r.f_stat == round((26 / 2) / (6 / 6), 4)
    assert r.p_value == round(f_survival(13.0, 2, 6), 6) and r.result == "SIGNIFICANT"


def test_confidence_interval(spark):
    vals = [10.0, 12.0, 14.0, 16.0, 18.0, 20.0, 22.0, 24.0, 26.0, 28.0, 30.0]
    ci = st.confidence_intervals(st.group_moments(_claims(spark, {"A": vals}))).collect()[0]
    mean = sum(vals) / len(vals)
    s = math.sqrt(sum((x - mean) ** 2 for x in vals) / (len(vals) - 1))
    margin = 2.228138851986 * s / math.sqrt(len(vals))
    assert ci.mean == round(mean, 2) and ci.margin == round(margin, 2)
    assert ci.ci_lower == round(mean - margin, 2)
