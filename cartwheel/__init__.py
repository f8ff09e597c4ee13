"""cartwheel: customer analytics for online shops, expressed as Spark jobs.

Clickstream + item-property changelog -> price-enriched events -> user
features and bot flags -> RFM segments -> lifetime value -> churn and
survival -> discount-policy simulation -> visitor-day dashboard table.
"""

__version__ = "0.1.0"

# Ship the package's functions inside the pickled task closures (pandas UDFs,
# mapInPandas kernels) so executors need no copy of this repository.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
