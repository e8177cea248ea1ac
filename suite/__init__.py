"""Registered queries over the given tables, with the SQL that checks them."""


import sys

from pyspark import cloudpickle

# The small chat clients of the queries travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        catalog_queries,
        judge_queries,
        profile_queries,
        search_queries,
    )
