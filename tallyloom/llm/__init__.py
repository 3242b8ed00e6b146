"""Operators of a training-data pipeline. Nothing else in the library imports them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so that a worker
# needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
