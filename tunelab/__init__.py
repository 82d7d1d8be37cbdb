"""Spark-native data work around language-model fine-tuning."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions of this package travel to the executors inside the
# tasks, so the package needs to be on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
