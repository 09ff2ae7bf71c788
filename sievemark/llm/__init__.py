"""Operators for training-data pipelines: tokenizers, scans, near copies, language models, classifiers."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
