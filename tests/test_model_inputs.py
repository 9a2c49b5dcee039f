"""Model-input tables on literal observations and the published golden chain."""

import datetime as dt

import pytest

from tidemark.operators import inputs, latest
from tidemark.sources import tables

# --- fixed values: published inputs (segment, product, source, value) and results --------
PD = """commercial_property ANZ_PILLAR3_CRE_PD .021|commercial_property CBA_PILLAR3_CRE_PD .025|commercial_property MACQUARIE_CRE_PD .013616
commercial_property NAB_PILLAR3_CRE_PD .022|commercial_property WBC_PILLAR3_CRE_PD .026|corporate_general MACQUARIE_CORP_PD .016959
corporate_sme ANZ_PILLAR3_CORP_SME .034|corporate_sme CBA_PILLAR3_CORP_SME .028|corporate_sme MACQUARIE_SME_PD .027788
corporate_sme NAB_PILLAR3_CORP_SME .032|corporate_sme WBC_PILLAR3_CORP_SME .027|development APS113_GOOD_PD .008|development APS113_SATIS_PD .028
development APS113_STRONG_PD .004|development APS113_WEAK_PD .08|financial_institution MACQUARIE_FI_PD .004938|residential_mortgage ANZ_RES .008
residential_mortgage CBA_RES .0072|residential_mortgage MACQUARIE_RES .006321|residential_mortgage NAB_RES .009|residential_mortgage WBC_RES .0088
retail_other MACQUARIE_OTHER .015546|retail_sme MACQUARIE_RSME .028911|sovereign MACQUARIE_SOV .009"""
LGD = """commercial_property APS113_CRE_LGD_FLOOR .175|commercial_property MACQUARIE_CRE_LGD .242459|corporate_general MACQUARIE_CORP_LGD .454809
corporate_sme MACQUARIE_SME_LGD .418057|development APS113_GOOD_LGD .325|development APS113_SATIS_LGD .375|development APS113_STRONG_LGD .275
development APS113_WEAK_LGD .45|financial_institution MACQUARIE_FI_LGD .489287|invoice_finance APS113_INVOICE_LGD .35
residential_mortgage APS113_RES_LGD .075|residential_mortgage CBA_RES_LGD .22|residential_mortgage MACQUARIE_RES_LGD .127374
residential_mortgage NAB_RES_LGD .24|retail_other MACQUARIE_OTHER_LGD .363578|retail_sme MACQUARIE_RSME_LGD .413695
sovereign MACQUARIE_SOV_LGD .052111|working_capital_unsecured APS113_UNSEC_LGD .45|working_capital_unsecured CBA_UNSEC_LGD .48"""
EXPECTED_LOSS = {
    "commercial_property": (.022, .20873, .004592, 46), "corporate_general": (.016959, .454809, .007713, 77),
    "corporate_sme": (.028, .418057, .011706, 117), "development": (.018, .35, .0063, 63),
    "financial_institution": (.004938, .489287, .002416, 24), "residential_mortgage": (.008, .173687, .001389, 14),
    "retail_other": (.015546, .363578, .005652, 57), "retail_sme": (.028911, .413695, .01196, 120), "sovereign": (.009, .052111, .000469, 5),
}
STRESSED = {  # (segment, scenario) -> stressed PD, LGD, EL, EL with exposure
    ("commercial_property", "mild"): (.05, .250476, .012524, .013776), ("commercial_property", "severe"): (.055, .292222, .016072, .02009),
    ("corporate_general", "mild"): (.025438, .545771, .013884, .015272), ("corporate_sme", "severe"): (.07, .58528, .04097, .051212),
    ("development", "severe"): (.05, .49, .0245, .030625), ("residential_mortgage", "mild"): (.012, .208424, .002501, .002751),
    ("retail_sme", "severe"): (.072277, .579173, .041861, .052326), ("sovereign", "base"): (.009, .052111, .000469, .000469),
}


def golden(observe):
    rows = []
    for parameter, text in (("pd", PD), ("lgd", LGD)):
        for entry in text.replace("\n", "|").split("|"):
            segment, source, value = entry.split()
            rows.append({"segment": segment, "source_id": source, "value": float(value), "parameter": parameter,
                         "source_type": "apra_performance" if source.startswith("APS113") else "bank_pillar3"})
    return observe(*rows)


def test_golden_chain(spark, observe):
    bundle = inputs.model_input_bundle(golden(observe), tables.stress_scenarios(), tables.reality_check_bands(spark))
    assert (bundle["pd_inputs"].count(), bundle["lgd_inputs"].count()) == (24, 19)
    el = {r.segment: (r.pd_decimal, r.lgd_decimal, r.expected_loss_rate_decimal, r.expected_loss_rate_bps)
          for r in bundle["expected_loss_inputs"].collect()}
    assert el == EXPECTED_LOSS
    stress = {(r.segment, r.scenario): r for r in bundle["stress_testing_inputs"].collect()}
    assert len(stress) == 27
    for key, want in STRESSED.items():
        r = stress[key]
        got = (r.stressed_pd_decimal, r.stressed_lgd_decimal, r.stressed_expected_loss_rate_decimal, r.stressed_el_rate_incl_ead_decimal)
        assert got == pytest.approx(want, abs=1.01e-6)
    assert bundle["stress_testing_inputs"].columns[:4] == ["segment", "segment_label", "product", "scenario"]


def test_reverse_stress_multipliers(spark, observe):
    el = inputs.expected_loss(inputs.rate_summary(latest.latest_numeric(golden(observe))))
    got = {r.segment: r.breach_pd_multiplier for r in inputs.reverse_stress(el, tables.reality_check_bands(spark)).collect()}
    assert got == {"commercial_property": 2.27, "corporate_sme": 2.14, "development": 2.78}


def test_proxy_lgd_feeds_loss_rate_not_expected_loss(observe):
    obs = observe(
        {"source_id": "CBA_PD", "value": .02},
        {"source_id": "APS113_CRE", "value": .175, "parameter": "lgd", "data_definition_class": "regulatory_floor_lgd", "source_type": "apra_performance"},
        {"source_id": "PEPPER_ECL_LGD", "value": .0039, "parameter": "lgd", "source_type": "non_bank_listed"})
    summary = inputs.rate_summary(latest.latest_numeric(obs))
    assert inputs.expected_loss(summary).first().lgd_decimal == .175
    row = inputs.portfolio_monitor(summary).first()
    assert (row.loss_rate_decimal, row.loss_rate_source_count, row.arrears_source_count) == (.0039, 1, 0)


def test_latest_takes_newest_then_store_order(observe):
    obs = observe(
        {"source_id": "A", "value": .1, "as_of_date": dt.date(2023, 12, 31)}, {"source_id": "A", "value": .2},
        {"source_id": "A", "value": .3}, {"source_id": "A", "value": None, "as_of_date": dt.date(2025, 12, 31)},
        {"source_id": "B", "value": .5, "segment": "commercial_property_investment"}, {"source_id": "C", "value": .7, "product": ""})
    got = {r.source_id: (r.segment, r["product"], r.value) for r in latest.latest_numeric(obs).collect()}
    assert got == {"A": ("commercial_property", "commercial_property", .2), "B": ("commercial_property", "commercial_property", .5),
                   "C": ("commercial_property", "commercial_property", .7)}


def test_trend_compares_two_newest_dates(observe):
    obs = observe({"source_id": "A", "value": .0120, "as_of_date": dt.date(2023, 12, 31)}, {"source_id": "A", "value": .0124},
                  {"source_id": "A", "value": .9}, {"source_id": "B", "value": .1})
    row = latest.segment_trend(obs).collect()
    assert len(row) == 1 and row[0].delta == pytest.approx(.0004) and row[0].current_value == .0124


def test_scenarios_and_bands_load_from_yaml(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("scenarios:\n  up:\n    label: 'a  b'\n    pd_multiplier: 2\n    lgd_multiplier: 1\n    ccf_multiplier: 1\n    macro_path: >-\n      x\n      y\n")
    (tmp_path / "b.yaml").write_text("products:\n  p:\n    lower_band_pd: 0.1\n    upper_band_pd: 0.2\n    upper_sources: [a]\n    lower_sources: [b]\n")
    assert tables.stress_scenarios(str(tmp_path / "s.yaml"))[0][1:4] == ("up", "a b", 2.0)
    assert tables.reality_check_bands(spark, str(tmp_path / "b.yaml")).first().upper_sources == ["a"]
