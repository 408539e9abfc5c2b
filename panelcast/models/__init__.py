"""Forecast models.

Functions that run in Python workers are shipped by value, so the executors need numpy and pandas
but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["panelcast"])
