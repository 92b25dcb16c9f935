"""What goes to the tasks: broadcasts of this package's own objects, pickled by value, so that executors need not have the
package installed; and Arrow batches of texts that stay small on both sides of the pipe."""

from __future__ import annotations

from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import SparkSession

BATCH_ROWS = 2048


def share(context: SparkContext, value: object) -> Broadcast:
    return context.broadcast(cloudpickle.dumps(value))


def load(shared: Broadcast) -> object:
    return cloudpickle.loads(shared.value)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batches to ``rows`` rows (texts are long rows); a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)
