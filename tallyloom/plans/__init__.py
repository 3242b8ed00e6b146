"""Registered queries by subject."""

from __future__ import annotations

import importlib
from types import ModuleType

SUBJECTS = ("words", "tables", "moments", "files", "networks", "library", "streams")


def load_all() -> ModuleType:
    """Import every subject and return the registry they filled."""
    for subject in SUBJECTS:
        importlib.import_module(f"tallyloom.plans.{subject}")
    return importlib.import_module("tallyloom.plans.registry")
