"""Spark-native analysis of account transactions, in batch and as streams."""

import sys

from pyspark import cloudpickle

from tallyguard.params import RuleParams, ScaleParams

# Executors need no copy of this package: its few Python functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["RuleParams", "ScaleParams"]
