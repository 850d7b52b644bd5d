"""Captured bodies as a stream whose every micro-batch is one commit.

``foreachBatch`` runs a batch again if the process dies after its work and before the checkpoint notes it. The batch's number is in
the same commit as its rows, so the second time there is nothing to do: raw rows, dead letters, rejects, staging, marts,
counts and cursors hold each body once.

The pages of one indicator's response arrive in any micro-batches. ``kept_pages`` holds, for each run and indicator, which pages it
has seen and where the stop rule ends them; it emits a page once all pages before it are there and none of them ends the run of pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rawmart import fixed as X
from rawmart.operators.quality import DEFAULT_MEASURES
from rawmart.operators.snapshots import Store, Transaction, transact
from rawmart.plans.ingest import ingest
from rawmart.plans.job import build_batches
from rawmart.sources.bodies import PAGE_KEYS, page_stops


def stream_hourly(
    spark: SparkSession,
    store: Store,
    bodies: DataFrame,
    locations: DataFrame,
    checkpoint: str,
    stream: str,
    tz: str = "UTC",
    enabled_variants: Sequence[str] = X.VARIANTS,
    measures: Sequence[str] = DEFAULT_MEASURES,
    after_commit: Callable[[int], None] | None = None,
) -> int:
    """Take all hourly bodies that the streaming DataFrame has by now into ``store``; returns the newest version.

    ``bodies`` has the columns of ``schemas.HOURLY_BODY``. ``stream`` names the stream in the store: it belongs to the checkpoint, a
    new checkpoint needs a new name. ``after_commit`` is called with each batch's number once its commit is visible.
    """

    def take(batch: DataFrame, number: int) -> None:
        def work(txn: Transaction) -> None:
            if txn.mark(stream, number):
                ingest(txn, build_batches(None, batch, locations, None, None, enabled_variants, measures), tz, measures)

        transact(store, work)
        if after_commit is not None:
            after_commit(number)

    bodies.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return store.state().version


# ---------------------------------------------------------------- page rule with state

_STATE = "last int, ended boolean, waiting array<int>, stops array<int>"
_KEPT = "extract_run_id string, indicator_id string, page_no int"


def _advance(key: tuple, pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Pages that are kept now. State: the last kept page, whether it ends the response, and pages that wait for one before them
    (with their stop flag); a response has few pages, of which the state holds numbers only."""
    last, ended, waiting, stops = state.get if state.exists else (0, False, [], [])
    ahead = dict(zip(waiting, stops, strict=True))
    for part in pages:
        for page, stop in zip(part["page_no"], part["stop"], strict=True):
            if page > last:
                ahead[int(page)] = min(int(stop), ahead.get(int(page), 2))
    kept = []
    while not ended and last + 1 in ahead:
        stop = ahead.pop(last + 1)
        if stop == 0:  # empty: it ends the response and is not kept itself
            ended = True
        else:
            last += 1
            kept.append(last)
            ended = stop == 1
    rest = {} if ended else ahead
    state.update((last, ended, list(rest), list(rest.values())))
    yield pd.DataFrame({"extract_run_id": [key[0]] * len(kept), "indicator_id": [key[1]] * len(kept), "page_no": pd.array(kept, dtype="int32")})


def kept_pages(bodies: DataFrame) -> DataFrame:
    """Pages (extract_run_id, indicator_id, page_no) that the stop rule keeps, of a streaming DataFrame of captured pages.

    Only page numbers and stop flags are grouped by run and indicator, never bodies. A page that comes twice counts once; of two
    with one number the one that stops earlier decides, if both are there before it is kept.
    """
    stops = page_stops(bodies)
    return stops.groupBy(*PAGE_KEYS).applyInPandasWithState(_advance, _KEPT, _STATE, "append", GroupStateTimeout.NoTimeout)


def stream_pages(spark: SparkSession, bodies: DataFrame, checkpoint: str, store: Store, stream: str, table: str = "capture/kept_page") -> int:
    """Append the pages that are kept to a table of the store, each once; returns the newest version."""

    def take(batch: DataFrame, number: int) -> None:
        def work(txn: Transaction) -> None:
            if txn.mark(stream, number):
                txn.append(table, batch, "indicator_id")

        transact(store, work)

    kept_pages(bodies).writeStream.foreachBatch(take).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return store.state().version
