"""All registered queries."""

from __future__ import annotations

import importlib

MODULES = ["checks.star", "checks.docs", "checks.vocab", "checks.web", "checks.whole"]


def _modules():
    return [importlib.import_module(name) for name in MODULES]


def queries():
    return {name: f for module in _modules() for name, f in module.QUERIES.items()}


def statements():
    return {name: s for module in _modules() for name, s in module.SQL.items()}
