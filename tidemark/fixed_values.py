"""Fixed domain values.

Everything here is a published label, code, rate or threshold that results must
agree with. No logic lives in this module.
"""

from __future__ import annotations

# --- fixed values: enumerations ------------------------------------------------

SOURCE_TYPES = (
    "pillar3", "apra_adi", "rating_agency", "industry_body", "listed_peer",
    "regulatory", "rba", "bureau", "insolvency", "bank_pillar3",
    "non_bank_listed", "apra_qpex", "apra_performance", "apra_non_adi",
    "rating_agency_index", "rba_aggregate",
)
DATA_TYPES = (
    "pd", "lgd", "default_rate", "impaired_ratio", "recovery_rate",
    "failure_rate", "supervisory_value",
)
BOUNDED_DATA_TYPES = (
    "pd", "lgd", "default_rate", "impaired_ratio", "recovery_rate", "failure_rate",
)
COMPONENT_DATA_TYPES = ("lgd", "recovery_rate")
CONDITIONS = ("normal", "downturn")
COMPONENTS = ("haircut", "time_to_recovery", "workout_costs", "discount_rate")
QUALITY_SCORES = ("HIGH", "MEDIUM", "LOW")
PARAMETERS = ("pd", "lgd", "arrears", "impaired", "npl", "loss_rate", "commentary")
MONITOR_PARAMETERS = ("arrears", "npl", "impaired", "loss_rate")

# --- fixed values: parameter -> legal definition classes -------------------------

LEGAL_CLASSES = {
    "pd": ("basel_pd_one_year", "regulatory_floor_pd"),
    "lgd": ("realised_loss_rate", "regulatory_floor_lgd"),
    "arrears": ("arrears_30_plus_days", "arrears_90_plus_days"),
    "impaired": ("impaired_loans_ratio",),
    "npl": ("npl_ratio",),
    "loss_rate": ("loss_expense_rate", "realised_loss_rate"),
    "commentary": ("qualitative_commentary",),
}

# --- fixed values: segments and products -----------------------------------------

SEGMENT_ALIASES = {"commercial_property_investment": "commercial_property"}

SEGMENT_TO_PRODUCT = {
    "bridging_residential": "bridging",
    "commercial_property": "commercial_property",
    "corporate_sme": "term_loan",
    "development": "development",
    "invoice_finance": "invoice_finance",
    "residential_mortgage": "residential_mortgage",
    "residential_mortgage_specialist": "residential_mortgage_specialist",
    "sme_corporate": "term_loan",
    "working_capital_unsecured": "line_of_credit",
}

SEGMENT_GLOSSARY = {
    "adi_sector_total": "APRA sector-level aggregate across ADI loan portfolios, used for system-wide NPL and arrears trend context.",
    "bridging_residential": "Short-tenor bridging and residual-stock residential lending, typically secured by residential property and repaid from sale or refinance.",
    "commercial_property": "Income-producing and investment commercial real estate exposures, including office, retail, industrial and mixed-use CRE lending.",
    "corporate_sme": "Small and medium enterprise corporate lending, including term debt and working-capital style facilities to trading businesses.",
    "development": "Construction and land-development lending, including specialised lending slotting-style project finance and staged draw structures.",
    "invoice_finance": "Receivables-backed lending such as invoice discounting and factoring, where repayment is supported by short-dated trade debtors.",
    "residential_mortgage": "Prime residential home lending secured by owner-occupied or standard investment housing collateral.",
    "residential_mortgage_specialist": "Specialist or non-conforming residential mortgages, including near-prime and credit-impaired borrower cohorts.",
    "residential_mortgage_arrears": "Residential mortgage arrears reference segment used for governance and reality checks rather than direct peer-PD comparison.",
    "residential_mortgage_specialist_arrears": "Specialist residential arrears reference segment for non-conforming mortgage pools and adjacent stress-testing comparisons.",
    "sme_corporate": "System-wide SME and commercial lending aggregate used as an external reference point for bank and non-bank portfolio benchmarks.",
    "working_capital_unsecured": "Unsecured working-capital and general corporate facilities without specific collateral support, typically revolving or short-tenor.",
}
GLOSSARY_DEFAULT = "Definition pending for this canonical segment."

# --- fixed values: cohorts and banks ----------------------------------------------

BIG4 = ("cba", "nab", "wbc", "anz")
MACQUARIE_HEADS = ("mqg", "macquarie")
PEER_COHORTS = ("peer_big4", "peer_non_bank")
REFERENCE_COHORTS = (
    "peer_other_major_bank", "regulator_aggregate", "rating_agency",
    "regulatory_floor", "industry_body",
)
COHORT_ORDER = (
    "peer_big4", "peer_other_major_bank", "peer_non_bank", "regulator_aggregate",
    "rating_agency", "regulatory_floor", "industry_body",
)
COHORT_LABELS = {
    "peer_big4": "Big 4 banks",
    "peer_other_major_bank": "Other major bank (Macquarie)",
    "peer_non_bank": "Non-bank peers",
    "regulator_aggregate": "Regulator aggregate",
    "rating_agency": "Rating agency",
    "regulatory_floor": "Regulatory floor",
    "industry_body": "Industry body",
}
PARAMETER_LABELS = {
    "pd": "Probability of default (PD)",
    "lgd": "Loss given default (LGD)",
    "arrears": "Arrears",
    "impaired": "Impaired loans",
    "npl": "Non-performing loans (NPL)",
    "loss_rate": "Loss rate",
    "commentary": "Qualitative commentary",
}
BANK_NAMES = {
    "cba": "Commonwealth Bank", "nab": "NAB", "wbc": "Westpac", "anz": "ANZ",
    "mqg": "Macquarie", "macquarie": "Macquarie",
}
NON_BANK_NAMES = {
    "liberty": "Liberty Financial", "pepper": "Pepper Money", "resimac": "Resimac",
    "moneyme": "MoneyMe", "plenti": "Plenti", "qualitas": "Qualitas",
    "metrics": "Metrics Credit Partners", "latrobe": "La Trobe Financial",
    "latitude": "Latitude Financial", "humm": "humm Group", "zip": "Zip Co",
}
SLOTTING_LABELS = {
    "STRONG": "Strong", "GOOD": "Good", "SATIS": "Satisfactory", "WEAK": "Weak",
}
LGD_FLOOR_LABELS = {
    "RES_LGD_FLOOR": "APS 113 LGD floor (residential)",
    "CRE_LGD_FLOOR": "APS 113 LGD floor (commercial)",
    "INVOICE_LGD_FLOOR": "APS 113 LGD floor (invoice finance)",
    "UNSECURED_LGD": "APS 113 LGD floor (senior unsecured)",
}
APRA_POPULATIONS = {
    "ALL_ADIS": "all ADIs", "BANKS": "banks", "MAJOR_BANKS": "major banks",
}
SOURCE_PREFIX_LABELS = {
    "APRA_QPEX_CRE_IMPAIRED": "APRA QPEX (commercial property impaired ratio)",
    "APRA_PERF_COMMERCIAL_NPL": "APRA performance (commercial NPL)",
    "RBA_FSR_HH_ARREARS": "RBA FSR (household 90+ arrears)",
    "RBA_FSR_BUSINESS_ARREARS": "RBA FSR (business arrears)",
    "RBA_FSR": "RBA FSR",
    "SP_SPIN_PRIME_RMBS": "S&P SPIN (prime RMBS, 30+ DPD)",
    "SP_SPIN_NON_CONFORMING": "S&P SPIN (non-conforming RMBS, 30+ DPD)",
    "SP_CORP_DEFAULT": "S&P (corporate default, global IG)",
    "AFIA_INVOICE": "AFIA (invoice finance loss rate)",
    "ILLION_BFRI": "illion BFRI",
}
SOURCE_TOKEN_LABELS = {
    "QUALITAS": "Qualitas (commentary)",
    "METRICS": "Metrics Credit (commentary)",
    "LATROBE": "La Trobe Financial (bridging realised loss)",
}

# --- fixed values: stress scenarios and reality-check bands -------------------------

# (ord, name, label, pd x, lgd x, ccf x, floor at the upper band?, macro path)
STRESS_SCENARIOS = (
    (0, "base", "Base (current environment)", 1.0, 1.0, 1.0, False,
     "Current conditions, no recession overlay. GDP growth around trend, unemployment broadly stable, cash rate and property prices at the latest observed levels (RBA SMP / FSR baseline)."),
    (1, "mild", "Mild recession (Basel CRE36.51 minimum)", 1.5, 1.2, 1.1, True,
     "Basel CRE36.51 mandatory minimum — two consecutive quarters of zero GDP growth. Unemployment rises ~1.0-1.5pp, modest property-price softening (~5-10%), and some drawdown of undrawn limits as borrowers seek liquidity (PD/LGD/EAD all stressed)."),
    (2, "severe", "Severe recession (GFC-like)", 2.5, 1.4, 1.25, True,
     "GFC-like severe-but-plausible downturn (APS 220 para 72). Multi-quarter contraction, unemployment +3-4pp, property prices -20% to -30%, and a sharp utilisation spike on revolving facilities into default."),
)

# product -> (lower PD, upper PD, upper source ids, lower source ids)
REALITY_CHECK_BANDS = {
    "term_loan": (0.005, 0.060, ["APRA_PERF_COMMERCIAL_NPL_2024Q4"], ["APRA_PERF_COMMERCIAL_NPL_2024Q4"]),
    "line_of_credit": (0.005, 0.075, ["APRA_PERF_COMMERCIAL_NPL_2024Q4"], ["APRA_PERF_COMMERCIAL_NPL_2024Q4"]),
    "invoice_finance": (0.005, 0.045, ["APRA_PERF_COMMERCIAL_NPL_2024Q4"], ["APRA_PERF_COMMERCIAL_NPL_2024Q4"]),
    "trade_finance": (0.003, 0.030, ["CBA_PILLAR3_CORP_SME_2024H2"], ["CBA_PILLAR3_CORP_SME_2024H2"]),
    "asset_finance": (0.005, 0.060, ["APRA_PERF_COMMERCIAL_NPL_2024Q4"], ["APRA_PERF_COMMERCIAL_NPL_2024Q4"]),
    "bridging": (0.015, 0.080, ["LATROBE_BRIDGING_REALISED_LOSS", "APS113_SLOTTING_SATIS_PD"], ["APS113_SLOTTING_GOOD_PD"]),
    "development": (0.008, 0.050, ["APS113_SLOTTING_WEAK_PD"], ["APS113_SLOTTING_GOOD_PD"]),
    "commercial_property": (0.005, 0.050, ["APRA_QPEX_CRE_IMPAIRED_2024Q4", "CBA_PILLAR3_CRE_PD_2024H2"], ["APRA_QPEX_CRE_IMPAIRED_2024Q4"]),
    "residential_mortgage_arrears": (0.005, 0.025, ["sp_spin_prime"], ["sp_spin_prime"]),
    "residential_mortgage_specialist_arrears": (0.020, 0.060, ["sp_spin_non_conforming"], ["sp_spin_non_conforming"]),
}
BAND_REFERENCE_SOURCES = {
    "apra_total_adi_npl": "APRA_PERF_COMMERCIAL_NPL_2024Q4",
    "rba_business_arrears": "RBA_FSR_BUSINESS_ARREARS_2024H2",
    "sp_spin_prime_rmbs": "sp_spin_prime",
    "sp_spin_non_conforming_rmbs": "sp_spin_non_conforming",
}

# --- fixed values: staleness, quality, thresholds -----------------------------------

REFRESH_DAYS = {
    "pillar3": 120, "apra_adi": 120, "rating_agency": 395, "industry_body": 210,
    "listed_peer": 210, "rba": 210, "bureau": 120, "regulatory": 760,
    "apra_insight": 30, "cfr_publications": 30,
}
REFRESH_FAMILY = {
    "bank_pillar3": "pillar3", "non_bank_listed": "listed_peer",
    "apra_qpex": "apra_adi", "apra_performance": "apra_adi",
    "rba_aggregate": "rba", "rating_agency_index": "rating_agency",
}
DEFAULT_STALE_DAYS = 210
DEFAULT_GOVERNANCE_STALE_DAYS = 365

QUALITY_DIMENSIONS = (
    "depth", "relevance", "transparency", "frequency", "regulatory_standing",
)
QUALITY_MATRIX = {
    "pillar3": ("HIGH", "HIGH", "HIGH", "HIGH", "HIGH"),
    "apra_adi": ("HIGH", "HIGH", "HIGH", "HIGH", "HIGH"),
    "rating_agency": ("HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM"),
    "industry_body": ("MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM", "LOW"),
    "listed_peer": ("MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM", "LOW"),
    "regulatory": ("HIGH", "HIGH", "HIGH", "LOW", "HIGH"),
    "rba": ("HIGH", "HIGH", "HIGH", "MEDIUM", "HIGH"),
    "bureau": ("MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "MEDIUM"),
    "insolvency": ("MEDIUM", "MEDIUM", "MEDIUM", "LOW", "HIGH"),
}
OUTLIER_MULTIPLE = 2.0
OWN_VS_PEER_DIVERGENCE = 0.30
PILLAR3_DIVERGENCE_MULTIPLE = 3.0
PILLAR3_MIN_COHORT = 3
DRIFT_SHARE = 0.30
COVERAGE_MIN_SOURCES = 2
LOW_COVERAGE = 0.60

# --- fixed values: ingest maps ---------------------------------------------------------

# ordered: the first prefix wins when there is no exact match
PUBLISHER_SOURCE_TYPES = {
    "APRA": "apra_adi",
    "CBA": "pillar3",
    "Commonwealth Bank of Australia": "pillar3",
    "NAB": "pillar3",
    "National Australia Bank": "pillar3",
    "WBC": "pillar3",
    "Westpac Banking Corporation": "pillar3",
    "ANZ": "pillar3",
    "Australia and New Zealand Banking Group": "pillar3",
    "Macquarie Bank": "pillar3",
    "Macquarie Bank Limited": "pillar3",
    "illion": "bureau",
    "S&P": "rating_agency",
    "S&P Global Ratings": "rating_agency",
    "Moody's": "rating_agency",
    "CoreLogic": "industry_body",
    "CoreLogic Australia": "industry_body",
    "JLL": "industry_body",
    "JLL Australia": "industry_body",
    "AFIA": "industry_body",
    "RBA": "rba",
    "La Trobe Financial": "listed_peer",
    "Qualitas": "listed_peer",
}
ASSET_CLASS_LABELS = {
    "residential": "residential_mortgage",
    "residential mortgage": "residential_mortgage",
    "residential mortgages": "residential_mortgage",
    "residential mortgages - owner occupied": "residential_mortgage",
    "residential mortgages - investor": "residential_mortgage",
    "commercial": "commercial_property_investment",
    "commercial property": "commercial_property_investment",
    "commercial property investment": "commercial_property_investment",
    "cre": "commercial_property_investment",
    "cre investment": "commercial_property_investment",
    "corporate": "corporate_sme",
    "corporate sme": "corporate_sme",
    "corporate (incl. sme corporate)": "corporate_sme",
    "corporate general": "corporate_general",
    "sme": "corporate_sme",
    "sme corporate": "corporate_sme",
    "sme retail": "retail_sme",
    "retail sme": "retail_sme",
    "other retail": "retail_other",
    "financial institution": "financial_institution",
    "sovereign": "sovereign",
    "bridging residential": "bridging_residential",
    "bridging commercial": "bridging_commercial",
    "development": "development",
    "invoice finance": "invoice_finance",
    "trade finance": "trade_finance",
    "working capital unsecured": "working_capital_unsecured",
    "working capital secured": "working_capital_secured",
}
METRIC_DATA_TYPES = {
    "pd": "pd", "probability_of_default": "pd",
    "lgd": "lgd", "loss_given_default": "lgd",
    "default_rate": "default_rate",
    "90dpd": "impaired_ratio", "90_dpd": "impaired_ratio",
    "impaired": "impaired_ratio", "impaired_ratio": "impaired_ratio",
    "npl": "impaired_ratio", "non_performing": "impaired_ratio",
    "recovery_rate": "recovery_rate", "recovery": "recovery_rate",
    "failure_rate": "failure_rate", "failure": "failure_rate",
    "supervisory": "supervisory_value", "supervisory_value": "supervisory_value",
    "regulatory_floor": "supervisory_value",
}
UNIT_DIVISORS = {
    "ratio": 1.0, "decimal": 1.0, "percent": 100.0, "percentage": 100.0,
    "basis_points": 10000.0, "bps": 10000.0, "months": 1.0, "dollars": 1.0,
}
LEGACY_SOURCE_TYPES = {
    "apra_adi": "apra_performance", "listed_peer": "non_bank_listed",
    "rating_agency": "rating_agency_index", "rba": "rba_aggregate",
    "bureau": "non_bank_listed", "regulatory": "apra_performance",
}
LEGACY_PILLAR3_HEADS = ("cba", "nab", "wbc", "anz", "mqg", "macquarie", "judo")

# canonical sheets: (source, column, metric, data type, unit, low, high)
SHEET_METRICS = (
    ("apra_adi_performance", "90DPD_Rate", "90dpd", "impaired_ratio", "ratio", 0.0, 0.20),
    ("apra_adi_performance", "NPL_Rate", "npl", "impaired_ratio", "ratio", 0.0, 0.30),
    ("apra_qpex", "Non_Performing_Ratio", "npl", "impaired_ratio", "ratio", 0.0, 0.30),
)
SHEET_LABEL_OVERRIDES = {
    "apra_adi_performance": {"Residential": "residential_mortgage", "Commercial": "commercial_property_investment", "Corporate": "corporate_sme"},
    "apra_qpex": {"Residential": "residential_mortgage", "Commercial": "commercial_property_investment"},
    "cba_pillar3": {"Residential Mortgage": "residential_mortgage", "CRE Investment": "commercial_property_investment", "Corporate SME": "corporate_sme", "Specialised Lending": "development"},
    "mqg_pillar3": {"Corporate": "corporate_general", "SME Corporate": "corporate_sme", "Specialised lending - IPRE": "commercial_property_investment", "Residential Mortgage": "residential_mortgage", "SME Retail": "retail_sme", "Other Retail": "retail_other"},
}
PILLAR3_RANGES = {
    "slotting_strong": (0.001, 0.010),
    "slotting_good": (0.003, 0.020),
    "slotting_satisfactory": (0.010, 0.060),
    "slotting_weak": (0.030, 0.200),
    "lgd": (0.0, 1.0),
    "residential": (0.003, 0.025),
    "commercial": (0.01, 0.08),
    "corporate": (0.01, 0.10),
}
METRIC_CEILINGS = {
    "npl_ratio": 0.10, "ninety_dpd_rate": 0.15, "pd": 1.01, "lgd": 1.0,
    "risk_weight": 3.0,
}

# --- fixed values: disclosure tables ------------------------------------------------------

# PD-band table labels, first contained pattern wins
BAND_TABLE_PORTFOLIOS = (
    ("rbnz regulated entities non-retail", "rbnz_non_retail"),
    ("rbnz regulated entities retail", "rbnz_retail"),
    ("qualifying revolving retail", "retail_qrr"),
    ("residential mortgage", "residential_mortgage"),
    ("sme retail", "retail_sme"),
    ("other retail", "retail_other"),
    ("corporate - large", "corporate_general"),
    ("corporate (incl. sme corporate)", "corporate_sme"),
    ("corporate", "corporate_general"),
    ("sovereign", "sovereign"),
    ("financial institution", "financial_institution"),
)
# labels of one bank come before the shared list
BANK_BAND_PORTFOLIOS = {
    "cba": (),
    "nab": (
        ("retail sme", "retail_sme"), ("large corporate", "corporate_general"),
        ("specialised lending income-producing real estate", "commercial_property_investment"),
        ("sovereign and central bank", "sovereign"), ("bank", "financial_institution"),
    ),
    "wbc": (
        ("rbnz regulated entities - non-retail", "rbnz_non_retail"),
        ("rbnz regulated entities - retail", "rbnz_retail"),
        ("retail sme", "retail_sme"), ("large corporate", "corporate_general"),
    ),
    "anz": (
        ("qualifying revolving retail (qrr)", "retail_qrr"),
        ("retail sme", "retail_sme"), ("large corporate", "corporate_general"),
    ),
}
MACQUARIE_PORTFOLIOS = (
    ("specialised lending - ipre", "commercial_property_investment"),
    ("specialised lending- ipre", "commercial_property_investment"),
    ("residential mortgage", "residential_mortgage"),
    ("sme corporate", "corporate_sme"),
    ("sme retail", "retail_sme"),
    ("other retail", "retail_other"),
    ("financial institution", "financial_institution"),
    ("corporate", "corporate_general"),
    ("sovereign", "sovereign"),
)
SLOTTING_RISK_WEIGHTS = (
    ("Strong", "development_strong", 0.70),
    ("Good", "development_good", 0.90),
    ("Satisfactory", "development_satisfactory", 1.15),
    ("Weak", "development_weak", 2.50),
    ("Default", "development_default", 0.00),
)
JUDO_NEEDLES = (
    "commercial real estate", "cre lending", "small and medium business",
    "sme lending", "construction", "sme", "cre",
)
TABLE_LABEL_CLASSES = (
    (("residential", "housing", "home loan", "owner-occupied"), "residential_mortgage"),
    (("commercial property", "commercial real estate", "commercial mortgage", "cre"), "commercial_property_investment"),
    (("corporate", "sme", "business lending"), "corporate_sme"),
    (("specialised", "specialized", "slotting"), "development"),
)

# segment -> source -> published aliases, in order
SEGMENT_ALIAS_MAP = {
    "commercial_property": {
        "cba": ["Commercial property", "CRE"], "nab": ["Commercial real estate"],
        "wbc": ["Commercial property"], "anz": ["Commercial property"],
        "judo": ["Commercial real estate", "CRE lending"],
        "liberty": ["Commercial property loans"], "pepper": ["Commercial loans"],
        "resimac": ["Commercial real estate"],
        "qualitas": ["Commercial property", "CRE", "Real estate credit"],
        "metrics_credit": ["Commercial property", "CRE", "Real estate credit"],
    },
    "commercial_property_investment": {
        "cba": ["Commercial property investment", "Investment property"],
        "nab": ["Commercial property investment"],
    },
    "development": {
        "cba": ["Development", "Property development"], "nab": ["Development"],
        "wbc": ["Development"], "anz": ["Development"], "judo": ["Construction"],
        "qualitas": ["Development", "Construction", "Build-to-rent", "BTR"],
        "metrics_credit": ["Development", "Construction"],
    },
    "bridging_residential": {
        "latrobe": ["Bridging", "Bridging finance"], "liberty": ["Bridging"],
    },
    "sme_corporate": {
        "cba": ["SME corporate", "Small and medium enterprises"], "nab": ["SME"],
        "wbc": ["SME corporate"], "anz": ["SME corporate"],
        "judo": ["Small and medium business", "SME lending"],
        "liberty": ["SME loans"], "pepper": ["SME / business"],
        "moneyme": ["SME / commercial loans"], "plenti": ["SME automotive"],
    },
    "residential_mortgage": {
        "cba": ["Residential mortgage", "Australian residential mortgages"],
        "nab": ["Residential mortgage"], "wbc": ["Residential mortgage"],
        "anz": ["Residential mortgage"], "pepper": ["Residential mortgages"],
        "resimac": ["Residential mortgages", "Prime", "Specialist"],
        "liberty": ["Residential mortgages"],
        "sp_spin": ["Prime SPIN", "Prime RMBS", "Prime residential mortgage"],
    },
    "residential_mortgage_specialist": {
        "sp_spin": ["Non-Conforming SPIN", "Non-conforming RMBS", "Specialist residential mortgage"],
        "resimac": ["Specialist"],
    },
    "consumer_unsecured": {
        "moneyme": ["Personal loan book"],
        "plenti": ["Personal loans", "Green loans", "Renewable energy loans"],
        "pepper": ["Consumer loans"], "latitude": ["Personal loans", "Consumer finance"],
        "humm": ["Consumer loans", "BNPL"], "zip": ["Consumer loans", "BNPL", "Receivables"],
    },
    "consumer_secured": {
        "pepper": ["Asset finance", "Automotive", "Auto loans"],
        "plenti": ["Automotive loans", "Auto loans", "Automotive"],
        "moneyme": ["Autopay", "Automotive"],
    },
    "trade_finance": {"cba": ["Trade finance"], "anz": ["Trade finance"]},
}

# --- fixed values: industry harmonisation ---------------------------------------------------

INDUSTRY_METRICS = (
    "exposure_aud_m", "npe_aud_m", "individually_assessed_provision_aud_m",
    "write_offs_aud_m",
)
STOCK_METRICS = (
    "exposure_aud_m", "npe_aud_m", "individually_assessed_provision_aud_m",
)
SUMMABLE_METRICS = ("exposure_aud_m", "npe_aud_m", "write_offs_aud_m")
PROVISION_BASES = ("aps220_specific", "aasb9_stage3_ecl")
REDACTION_REASONS = ("not_disclosed_in_published_table", "published_as_dash")
CONSUMER_BUCKETS = (
    "consumer_lending_personal", "consumer_lending_residential_mortgage",
    "consumer_combined",
)
CONSUMER_VIEWS = {
    "personal": "consumer_lending_personal",
    "residential_mortgage": "consumer_lending_residential_mortgage",
    "combined": "consumer_combined",
}
GOVERNMENT_LABELS = {
    "wbc": "Government, administration and defence",
    "nab": "Government and public authorities",
    "anz": "Government & Official Institutions",
    "cba": "Government Administration & Defence",
}
HONEST_ZERO_TABLES = (("cba", "CRB(e)(ii)"),)

INDUSTRY_BUCKETS = (
    "agriculture_mining", "manufacturing", "utilities", "construction", "trade",
    "accommodation_food", "transport_storage", "finance_insurance",
    "commercial_property", "business_property_services", "government_public",
    "consumer_lending_personal", "consumer_lending_residential_mortgage",
    "consumer_combined", "other",
)

BANK_INDUSTRY_LABELS = {
    "cba": {
        "Consumer": "consumer_combined",
        "Government Administration & Defence": "government_public",
        "Finance & Insurance": "finance_insurance",
        "Business Services": "business_property_services",
        "Agriculture & Forestry": "agriculture_mining",
        "Mining, Oil & Gas": "agriculture_mining",
        "Manufacturing": "manufacturing",
        "Electricity, Gas & Water": "utilities",
        "Construction": "construction",
        "Wholesale & Retail Trade": "trade",
        "Transport & Storage": "transport_storage",
        "Commercial Property": "commercial_property",
        "Entertainment, Leisure & Tourism": "other",
        "Health & Community Services": "other",
        "Other": "other",
    },
    "nab": {
        "Accommodation and hospitality": "accommodation_food",
        "Agriculture, forestry, fishing and mining": "agriculture_mining",
        "Business services and property services": "business_property_services",
        "Commercial property": "commercial_property",
        "Construction": "construction",
        "Finance and insurance": "finance_insurance",
        "Government and public authorities": "government_public",
        "Manufacturing": "manufacturing",
        "Personal": "consumer_lending_personal",
        "Residential mortgages": "consumer_lending_residential_mortgage",
        "Retail and wholesale trade": "trade",
        "Transport and storage": "transport_storage",
        "Utilities": "utilities",
        "Other": "other",
    },
    "wbc": {
        "Accommodation, cafes and restaurants": "accommodation_food",
        "Agriculture, forestry and fishing": "agriculture_mining",
        "Construction": "construction",
        "Finance and insurance": "finance_insurance",
        "Government, administration and defence": "government_public",
        "Manufacturing": "manufacturing",
        "Mining": "agriculture_mining",
        "Property": "commercial_property",
        "Property services and business services": "business_property_services",
        "Services": "business_property_services",
        "Trade": "trade",
        "Transport and storage": "transport_storage",
        "Utilities": "utilities",
        "Retail lending": "consumer_combined",
        "Other": "other",
    },
    "anz": {
        "Agriculture, Forestry, Fishing & Mining": "agriculture_mining",
        "Business & Property Services": "business_property_services",
        "Commercial Property": "commercial_property",
        "Construction": "construction",
        "Electricity, Gas & Water Supply": "utilities",
        "Entertainment, Leisure & Tourism": "other",
        "Financial, Investment & Insurance": "finance_insurance",
        "Government & Official Institutions": "government_public",
        "Manufacturing": "manufacturing",
        "Personal Lending": "consumer_lending_personal",
        "Residential Mortgage": "consumer_lending_residential_mortgage",
        "Retail Trade": "trade",
        "Transport & Storage": "transport_storage",
        "Wholesale Trade": "trade",
        "Other": "other",
    },
}
SYSTEM_INDUSTRY_LABELS = {
    "Agriculture, forestry and fishing": "agriculture_mining",
    "Mining": "agriculture_mining",
    "Manufacturing": "manufacturing",
    "Electricity, gas, water and waste services": "utilities",
    "Information media and telecommunications": "other",
    "Residential building construction": "construction",
    "Non-residential building construction": "construction",
    "Other construction": "construction",
    "Construction (total)": "construction",
    "Wholesale trade": "trade",
    "Retail trade": "trade",
    "Accommodation and food services": "accommodation_food",
    "Transport, postal and warehousing": "transport_storage",
    "Financial and insurance, excluding selected financial businesses": "finance_insurance",
    "Rental, hiring and real estate services": "business_property_services",
    "Professional, scientific and technical services": "business_property_services",
    "Administrative and support services": "business_property_services",
    "Public administration and safety": "government_public",
    "Education and training": "other",
    "Health care and social assistance": "other",
    "Arts and recreation services": "other",
    "Other services": "other",
}
SYSTEM_CONSTRUCTION_PARTS = (
    "Residential building construction", "Non-residential building construction",
    "Other construction",
)
SYSTEM_UNIVERSE_LABEL = "Total, excluding selected financial businesses"

MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
)
