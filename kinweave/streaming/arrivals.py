"""Candidates for queries that arrive as files, against a stored index of targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinweave.operators import lexical


def match_arrivals(queries: DataFrame, index: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, k: int = 20, country_block: bool = True) -> StreamingQuery:
    """Starts a stream that gives every batch of new queries (id, country, latin_name, latin_address) its candidates.

    index: the stored table that lexical.postings makes of the targets, so no batch
    works out their keys again.

    sink(candidates, batch number) is called once for each batch, again with the
    same number if a batch is repeated after a failure; a sink that overwrites by
    batch number therefore holds every result once.
    """
    columns = ("id", "country", "latin_name", "latin_address")
    def each(batch: DataFrame, number: int) -> None:
        sink(lexical.top_k(lexical.view_scores(batch.select(*columns), index, country_block), k), number)

    return queries.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
