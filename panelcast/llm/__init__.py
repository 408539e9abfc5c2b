"""Operators for preparing training text, each on whole ``documents``.  Nothing else imports them."""

import sys

from pyspark import cloudpickle

# Worker functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
