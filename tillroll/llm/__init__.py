"""Operators for preparing training data: one module per operator, the
registered queries in ``queries``, the pipeline in ``corpus_pipeline.py``
at the top of the repository.

The Python functions that run inside Spark tasks travel with the job
(pickled by value), so executors need numpy and pyarrow but no copy of
this package.
"""

from pyspark import cloudpickle

import tillroll.llm as _self

cloudpickle.register_pickle_by_value(_self)
