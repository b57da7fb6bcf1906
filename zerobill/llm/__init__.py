"""Training-data operators over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Each module holds one operator with a general interface; ``queries`` maps the
registered names to thin callables. Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
