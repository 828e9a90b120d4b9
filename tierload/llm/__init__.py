"""Training-data operators: formatting, deduplication, quality rules,
personal data, language-model scoring, rendering, token counts, mixing
and decontamination.  Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package on their path: task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
