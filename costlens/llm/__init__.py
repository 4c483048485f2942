"""Operators of a large-scale training-data pipeline.

Thirteen operators over the tables documents, embeddings, pages, benchmark, labels
and conversations. Nothing outside this package, ``corpus_pipeline.py`` and the
guarded block of ``__spark_entry__.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job: executors needn't have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
