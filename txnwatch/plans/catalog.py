"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from txnwatch.plans import catalog_alerts, catalog_contract, catalog_drift, catalog_evaluate, catalog_features, catalog_graph, catalog_model, catalog_state, catalog_stream  # noqa: F401
from txnwatch.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
