"""cohortlens: customer segmentation and activity timing as Spark DataFrame plans.

Operators are ``DataFrame -> DataFrame`` functions built from
``pyspark.sql.functions`` expressions, parameterised by the frozen dataclasses
in :mod:`cohortlens.config`. Two run numpy on Arrow batches inside tasks: the
passes of KMeans and the Euclidean silhouette.

Layout
------
- ``sources``    readers, sinks, and adapters from the test tables
- ``functions``  column-expression helpers (cut, id normalisation, weekday, ...)
- ``operators``  cleaning, RFM, statistics, features, clustering, profile,
                 temporal summaries, chart tables
- ``plans``      the composed stages and the registered query catalogue
- ``streaming``  the row-local cleaning rules applied to a file stream
"""

from cohortlens.config import (
    ClusterConfig,
    RFMConfig,
    TemporalConfig,
    TxConfig,
)

__all__ = ["ClusterConfig", "RFMConfig", "TemporalConfig", "TxConfig"]
