"""Training-data operators over documents, benchmark items and embeddings.

Nothing outside this package imports it.  Its Python functions travel to the
executors by value, so a cluster needs the libraries they call but no install
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
