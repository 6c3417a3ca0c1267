"""Operators for preparing large training corpora.

One module per operator; ``queries.py`` registers one query each.  Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions with the job, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
