"""Veredas: a PySpark-native engine for signal analytics and corpus preparation."""

import os
from pathlib import Path

# Python workers of a session started after this import find the package, from whatever folder the driver was started.
_ROOT = str(Path(__file__).resolve().parent.parent)
if _ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, os.environ.get("PYTHONPATH")) if p)
