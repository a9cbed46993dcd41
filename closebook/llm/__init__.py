"""Training-data operators: search, dedup, tokens, scans, mixing, language ID.

Nothing else in the library imports this subpackage. Its functions are
pickled by value, so executors need the third-party libraries only, not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
