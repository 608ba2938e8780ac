"""Collect passes as a stream: each micro-batch of stored pages is one pass over the kept tables.

Where stored pages land in a folder, a stream reads them as they come.  A micro-batch reads the latest state of its own
pages' buckets and no history; its id goes with what it writes, so a batch that a restarted query runs again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from offerledger.operators import ledger as G
from offerledger.operators import pages as P

def append_passes(pages: DataFrame, ledger: G.Ledger, checkpoint: str) -> StreamingQuery:
    """Parse every micro-batch and append changed offers, closures and reviews of failed pages to the ledger.

    pages: a streaming frame with alias, provider_id, provider, url, html, observed_at, and maybe fetch_error.  Of several
    pages of an alias in a micro-batch the last one counts.  The ledger's batches are numbered from 1.
    """

    def one_pass(batch: DataFrame, number: int) -> None:
        last = batch.groupBy("alias").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "alias"]), "observed_at").alias("p")).select("alias", "p.*")
        parsed = P.parse_pages(last).drop("html").persist()  # read for pages, offers and failures
        try:
            seen = P.observations(parsed).withColumn("run_id", F.lit(number + 1).cast("long"))
            columns = [c.split()[0] for c in G.HISTORY.split(", ")]
            G.record_observations(ledger, seen.select(*columns), parsed.where("error is null").select("alias", "observed_at"), number + 1)
            ledger.reviews.append(P.page_failures(parsed), ledger.in_one(), number + 1)
        finally:
            parsed.unpersist()

    return pages.writeStream.foreachBatch(one_pass).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
