"""Imports every query module so the registry is complete."""

from gatelake.plans import q_build, q_catalog, q_graph, q_ingest, q_netlist, q_text  # noqa: F401
from gatelake.plans.registry import ORACLES, QUERIES  # noqa: F401
