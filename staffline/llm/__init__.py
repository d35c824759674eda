"""Operators of a training-data pipeline over text and vector tables.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered query keys (``QUERIES``) and their DuckDB SQL (``ORACLES``).
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules["staffline"])
