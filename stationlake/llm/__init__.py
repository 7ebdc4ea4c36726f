"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``labels``.

Nothing else in the library imports this subpackage; its queries are registered by
``__spark_entry__.py`` when it is present.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel with the tasks, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
