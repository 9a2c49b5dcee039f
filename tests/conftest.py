from __future__ import annotations

import datetime as dt

import pytest

from tidemark import schemas
from tidemark.session import build_session

D = dt.date


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tidemark-tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CLASS_OF = {"pd": "basel_pd_one_year", "lgd": "realised_loss_rate", "arrears": "arrears_90_plus_days", "npl": "npl_ratio",
            "impaired": "impaired_loans_ratio", "loss_rate": "loss_expense_rate", "commentary": "qualitative_commentary"}


@pytest.fixture
def observe(spark):
    """Observation table from (source_id, value) plus overrides."""

    def build(*rows: dict):
        out = []
        for i, r in enumerate(rows):
            base = {"source_type": "bank_pillar3", "segment": "commercial_property", "product": None, "parameter": "pd",
                    "as_of_date": D(2024, 12, 31), "reporting_basis": "b", "methodology_note": "n", "sample_size_n": None,
                    "period_start": None, "period_end": None, "source_url": None, "page_or_table_ref": None, "obs_seq": i, **r}
            base.setdefault("data_definition_class", CLASS_OF[base["parameter"]])
            out.append(tuple(base[f] for f in schemas.RAW_OBSERVATIONS.fieldNames()))
        return spark.createDataFrame(out, schemas.RAW_OBSERVATIONS)

    return build


@pytest.fixture
def pages(spark):
    def build(*texts: str):
        return spark.createDataFrame([(f"d{i}", i, t) for i, t in enumerate(texts, 1)], schemas.PAGE_TEXT)

    return build
