"""Operators of a training-data pipeline: packing, mixing, deduplication,
classification, language-model scoring, sharding, chat formatting and HTML
extraction.

Every operator takes and returns DataFrames.  The Python kernels that run in
tasks are shipped by value, so executors need numpy and pyarrow but not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
