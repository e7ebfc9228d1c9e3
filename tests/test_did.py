"""Hand-computed difference-in-differences on a toy panel, plus invariants."""

import pytest

from policypanel.operators.did import did, did_estimate, did_flags, label_units, unit_era
from policypanel import schemas


def _panel(spark, levels):
    """levels: {unit: (pre_per_year, post_per_year)} with 2 pre and 2 post years;
    one row per event."""
    rows = []
    for unit, (pre, post) in levels.items():
        for year, per in [(2010, pre), (2011, pre), (2014, post), (2015, post)]:
            rows += [(unit, year)] * per
    return spark.createDataFrame(rows, "unit string, year int")


def _est(spark, levels, treated="T", controls=("A", "B")):
    df = _panel(spark, levels)
    return did_estimate(df, "unit", "year", treated, list(controls), cut=2014,
                        divisors={0: 2, 1: 2}).first()


def test_toy_panel_matches_hand_computation(spark):
    r = _est(spark, {"T": (100, 80), "A": (50, 60), "B": (30, 32)})
    assert r.treated_pre == 100 and r.treated_post == 80
    assert r.control_pre == 40 and r.control_post == 46
    assert r.did_estimate == pytest.approx(-26.0)  # pooled controls would give -32
    assert r.treated_pct_change == pytest.approx(-20.0)
    assert r.control_pct_change == pytest.approx(15.0)


def test_constant_shift_leaves_estimate_unchanged(spark):
    base = _est(spark, {"T": (100, 80), "A": (50, 60), "B": (30, 32)}).did_estimate
    shifted = _est(spark, {"T": (110, 90), "A": (60, 70), "B": (40, 42)}).did_estimate
    assert shifted == pytest.approx(base)


def test_treated_equal_to_controls_gives_zero(spark):
    r = _est(spark, {"T": (50, 60), "A": (50, 60), "B": (50, 60)})
    assert r.did_estimate == pytest.approx(0.0)


def test_swapping_eras_flips_sign(spark):
    a = _est(spark, {"T": (100, 80), "A": (50, 60), "B": (30, 32)}).did_estimate
    b = _est(spark, {"T": (80, 100), "A": (60, 50), "B": (32, 30)}).did_estimate
    assert a == pytest.approx(-b)


def test_missing_treated_gives_nulls_not_failure(spark):
    r = _est(spark, {"A": (50, 60), "B": (30, 32)})
    assert r.treated_pre is None and r.did_estimate is None
    assert r.control_pre == 40


def test_observed_divisors(spark):
    df = _panel(spark, {"T": (10, 20), "A": (5, 5)})
    t = {(x.unit, x.POST): x.fatalities_per_year
         for x in unit_era(df, "unit", "year", 2014).collect()}
    assert t[("T", 0)] == 10 and t[("T", 1)] == 20


def test_flags_and_unit_codes(spark):
    rows = [(36, 4170, 2013), (36, 4170, 2014), (17, 1670, 2015), (6, 4170, 2014), (36, None, 2014)]
    df = spark.createDataFrame(rows, "STATE int, CITY int, YEAR int")
    lab = label_units(df, schemas.CITY_CODES, ["STATE", "CITY"], "CITY_NAME")
    out = did_flags(lab, "CITY_NAME", "NYC", "YEAR", 2014).collect()
    got = sorted((r.CITY_NAME, r.YEAR, r.TREATMENT, r.POST, r.TREAT_POST) for r in out)
    # right CITY code with the wrong STATE is in no unit; null CITY is dropped
    assert got == [("Chicago", 2015, 0, 1, 0), ("NYC", 2013, 1, 0, 0), ("NYC", 2014, 1, 1, 1)]


def test_did_single_row_from_table(spark):
    table = spark.createDataFrame([("T", 0, 10.0), ("T", 1, 5.0), ("A", 0, 4.0), ("A", 1, 6.0)],
                                  "unit string, POST int, v double")
    r = did(table, "unit", "T", value="v").first()
    assert r.did_estimate == pytest.approx(-7.0)


def test_label_units_keep_unmatched_and_window(spark):
    rows = [(36, 4170, 2013), (6, 4170, 2014)]
    df = spark.createDataFrame(rows, "STATE int, CITY int, YEAR int")
    lab = label_units(df, schemas.CITY_CODES, ["STATE", "CITY"], "CITY_NAME", keep_unmatched=True)
    assert sorted((r.STATE, r.CITY_NAME) for r in lab.collect()) == [(6, None), (36, "NYC")]
    panel = _panel(spark, {"T": (10, 20), "A": (5, 5)})
    # a window that leaves only 2011 and 2014: one year on each side
    r = did_estimate(panel, "unit", "year", "T", ["A"], cut=2014, divisors={0: 1, 1: 1},
                     window=(2011, 2014)).first()
    assert (r.treated_pre, r.treated_post, r.did_estimate) == (10.0, 20.0, 10.0)
