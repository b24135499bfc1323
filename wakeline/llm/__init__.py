"""Operators for building training corpora: near-duplicates, mixing, secret and
personal-data scans, tokenization, fingerprints, url and html filters, quality.

The functions that run inside Python workers travel with the job, so executors
need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
