"""Spark operators over experiment logs, run metadata, artifact catalogs and telemetry."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
