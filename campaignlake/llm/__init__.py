"""Training-data operators: packing, nearest neighbours, mixing, near-duplicate
detection, language ID, quality, HTML extraction, toxicity, personal data and
a set-similarity join.  Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions with the plan, so that executors need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
