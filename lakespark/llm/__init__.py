"""Operators for preparing language-model training data.

The functions of this package that run inside tasks travel with the job, so executors
need numpy and pyarrow but not an installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
