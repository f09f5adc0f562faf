"""What running streams report after each micro-batch."""

from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

KEPT = 1000


class Progress(StreamingQueryListener):
    """Keeps the newest reports of all streams of a session, one dict a micro-batch, and the errors they ended with.

    ``dropped`` counts rows behind the watermark; for bounded counts it must stay 0.
    """

    def __init__(self, kept=KEPT):
        self.batches, self.errors = deque(maxlen=kept), deque(maxlen=kept)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append({
            "query": str(p.id), "batch_id": p.batchId, "rows": p.numInputRows, "watermark": p.eventTime.get("watermark"), "milliseconds": p.batchDuration,
            "state_rows": sum(o.numRowsTotal for o in p.stateOperators), "dropped": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
        })

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.errors.append((str(event.id), event.exception))

    def attached(self, spark: SparkSession) -> "Progress":
        spark.streams.addListener(self)
        return self
