"""tessera: customer / transaction analytics expressed as Spark DataFrame plans.

Layout
------
``sources``    table readers, schema checks and the bindings of logical tables
               (transactions, customers, prediction log, ...) to physical tables.
``functions``  pure ``Column -> Column`` helpers (bands, scores, ladders, formats).
``operators``  reusable DataFrame operators (keep-first, exact quantiles, ordered
               prefix sums, sessionisation, scaling, encoding, binary metrics).
``plans``      business composites built from the operators (RFM, ML dataset,
               insights, dashboard, drift, alerts, ROI, model training).
``streaming``  Structured Streaming versions of the incremental operators.
"""

__version__ = "0.1.0"
