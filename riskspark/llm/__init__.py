"""Operators for large training-text corpora (documents, conversations, benchmarks).

Nothing else in the library imports this subpackage; it imports general helpers
(`riskspark.session`) only.  One module per operator plus shared helpers:

* ``common``  - table reading, scratch tables in the shared folder, Arrow batch size
* ``textops`` - vectorised word / shingle / line hashing over Arrow string batches
* ``graph``   - connected components over link tables
* ``queries`` - the registered ``opN_*`` queries and their DuckDB SQL
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to Python workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
