"""A crawl fed by a stream of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from webloom.plans.crawl import Crawl, process_batch
from webloom.plans.store import CrawlStore


def distinct_stream(fetches: DataFrame) -> DataFrame:
    """The first arrival of every URL, kept in the state store.

    The state grows with the number of URLs, as a crawl's history does; the crawl
    below needs none, since the store itself knows what was visited.
    """
    return fetches.dropDuplicates(["url"])


def start_crawl(
    fetches: DataFrame,
    store: CrawlStore,
    crawl: Crawl,
    checkpoint: str,
    files: DataFrame | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Work arriving pages into the store, batch by batch.

    Spark keeps the progress under ``checkpoint``, and with it the stream's id, which
    tells its batches from those of other streams into the store. After a fault Spark
    repeats the last batch: one that the store has committed is left alone, of any
    other nothing counts. ``once`` takes what is there and ends.
    """

    def work(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(store, batch, crawl, files, batch=number, stream=stream)

    writer = fetches.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
