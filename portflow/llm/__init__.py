"""Operators for large training-data pipelines. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
