"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with their tasks, so executors need not
# have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
