"""Training-data operators: search, decontamination, filters, token counts, near duplicates, classifiers.

Nothing else in the library imports this subpackage. Functions that run inside tasks are pickled by
value, so executors need only the public Python packages, not an installed copy of this one.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
