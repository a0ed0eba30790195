"""Check-query catalog: every builder/operator exercised on the driver tables,
each with an independent DuckDB formulation (oracle) where SQL can express it."""
from . import application, behaviour, credit, history, modeling, portfolio, profile  # noqa: F401  (registers queries)
from .common import REGISTRY


def queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
