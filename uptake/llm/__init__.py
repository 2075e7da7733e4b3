"""Operators of a training-data pipeline: packing, sharding, language ID, near-duplicates, secrets, mixing, quality,
substring duplicates and WARC archives.

Nothing outside this subpackage imports it. Python functions that run on executors are pickled by value, so the
executors need numpy, pyarrow and the named libraries, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
