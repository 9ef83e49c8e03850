"""stratum - bronze / silver / gold CRM and ERP sales data on Spark.

Main entry points::

    from stratum import layers, silver, gold, tables
    layers.run_all(spark, layers.Roots(raw, bronze, silver_root, gold_root))

Column functions live in ``stratum.functions``, table operators in
``stratum.operators``, ingestion in ``stratum.streaming``.
"""

from stratum.operators.dedup import keep_first, keep_latest
from stratum.operators.lookup import lookup
from stratum.operators.surrogate import dense_key
from stratum.operators.versions import version_end
from stratum.plans import gold, layers, silver
from stratum.sinks import tables
from stratum.streaming.by_name import ingest_feed_by_name
from stratum.streaming.ingest import ingest_feed

__all__ = ["dense_key", "gold", "ingest_feed", "ingest_feed_by_name", "keep_first", "keep_latest",
           "layers", "lookup", "silver", "tables", "version_end"]
