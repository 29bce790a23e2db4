"""Composed plans: batch and sequential QC, long-term overlay, reports, query catalog."""

# the catalogue loads the query modules in an order that suits their imports of each other
from stationqc.plans import catalog  # noqa: F401
