"""Spark-native analytics over folders of model-described object transfers."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from basketlens.errors import TransferError  # noqa: E402
from basketlens.plans.catalog import Catalog  # noqa: E402

__all__ = ["Catalog", "TransferError"]
