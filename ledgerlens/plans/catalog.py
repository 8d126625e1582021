"""All registered queries."""

import importlib
import pkgutil

import ledgerlens.plans as _plans

from .registry import QUERIES

for _m in sorted(m.name for m in pkgutil.iter_modules(_plans.__path__) if m.name.startswith("q_")):
    importlib.import_module(f"ledgerlens.plans.{_m}")

__all__ = ["QUERIES"]
