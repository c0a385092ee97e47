"""Training-data operators (decontamination, near-dedup, quality, WARC, substring dedup,
BPE, line dedup, PII, token files, spelling variants, conversation repair).

Nothing outside this package imports it. The functions that run inside tasks are
shipped to the executors by value, so executors need the Python dependencies but
not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
