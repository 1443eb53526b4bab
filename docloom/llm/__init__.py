"""Training-data operators: text corpora in, per-document decisions out.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped with the job (pickled by value), so a cluster needs
the package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
