"""Accounts-payable document pipelines as Spark DataFrame jobs.

Subpackages
-----------
sources    input tables, file listings and the derived fixture views
functions  native column expressions (naming, text, dates, MIME, JSON)
operators  DataFrame -> DataFrame operators (lineage, listing, mail, text,
           extraction, classification, notifications, sinks, injected functions)
plans      the composite pipelines built from the operators
streaming  Structured Streaming forms of the polling jobs
"""
__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run in Python workers (pandas UDFs,
    ``mapInPandas``) are pickled by value, so executors need no installed
    copy of the package."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark always bundles it
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
