"""All registered checks."""

import importlib
import pathlib

from tidemill.checks.harness import CHECKS, oracle_text, run  # noqa: F401

MODULES = sorted(p.stem for p in pathlib.Path(__file__).parent.glob("*.py") if p.stem not in ("__init__", "harness"))


def load_all() -> dict:
    for module in MODULES:
        importlib.import_module(f"tidemill.checks.{module}")
    return CHECKS
