"""stationlake: factory test-station results as Spark DataFrame pipelines.

Raw station files (a short preamble with station, version, header and limit
lines, then one wide row per tested unit) are read as a ``LINES`` DataFrame
``(file_path, csv_file, line_no, value)`` and turned into long measurement
rows, run-summary rows, a specification-limit history and a per-file import
log -- all with built-in DataFrame operators.
"""

import sys

from pyspark import cloudpickle

from stationlake.session import build_session, checkpoint_root, staging_dir

__all__ = ["build_session", "checkpoint_root", "staging_dir"]

# functions of the library travel with the tasks, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
