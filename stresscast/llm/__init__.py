"""Training-data operators: extraction, quality, secrets, mixing, de-duplication, chat logs, token counts.

Nothing else in the library imports this subpackage. Python code that runs inside
tasks is pickled by value, so the workers need none of these modules installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
