"""Imports every query module so the registry is complete."""

from tidemark.plans import extract_queries, industry_queries, label_queries, model_queries, registry_queries, report_queries, source_queries  # noqa: F401
from tidemark.plans.catalog import ORACLES, QUERIES  # noqa: F401
