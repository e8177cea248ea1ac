"""Cataloom: dataset-catalogue analytics as Spark DataFrame operators.

Packages

* ``sources``   read and write stage tables, landed catalogue pages, landed CSV files, qrels
* ``functions`` column expressions (text, CSV text, JSON text, vectors, prompts)
* ``operators`` DataFrame -> DataFrame operators
* ``plans``     the composed end-to-end plans
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
