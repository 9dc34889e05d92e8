"""All registered queries (one per operator of the inventory) and their oracles."""

from __future__ import annotations

from tabforge.plans import catalog_eda, catalog_metrics, catalog_models, catalog_quality, catalog_scalars

_MODULES = [catalog_scalars, catalog_quality, catalog_eda, catalog_metrics, catalog_models]


def queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracles():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out


def flagship(spark, sf_dir):
    from tabforge.plans.flagship import price_by_level
    return price_by_level(spark, sf_dir)
