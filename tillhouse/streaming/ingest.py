"""Incremental fact loads: newly landed files, inserted batch by batch.

A batch is published in one version: its rows, its rejects and the note that the stream has got that
far. A batch that comes again after a crash is known by its stream and number and changes
nothing. A fresh checkpoint is another stream; then rows are known by their keys and rejects by
their content. Watermark deduplication would not do, since a key may come back after any time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tillhouse.operators.enforce import accepted
from tillhouse.operators.insert import not_in_target
from tillhouse.operators.outcomes import counts, rows_of, set_aside
from tillhouse.operators.scope import in_restaurants, restaurants_of
from tillhouse.plans.jobs import Context, Fact, outcomes
from tillhouse.schemas import REJECTS
from tillhouse.sinks.warehouse import Warehouse
from tillhouse.sources.landing import stream_pages


def identified(rejects: DataFrame) -> DataFrame:
    """Rejects with `reject_id`, a hash of their content."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in rejects.columns]
    return rejects.withColumn("reject_id", F.sha2(F.to_json(F.struct(*[p.alias(c) for p, c in zip(parts, rejects.columns)])), 256))


def insert_batch(store: Warehouse, fact: Fact, pages: DataFrame, stream: str, number: int) -> bool:
    """Loads one batch of pages and returns whether it was new.

    Rejects go to the table `REJECTS` of the same dataset. Staged tables of the batch are dropped.
    """
    if store.manifest().batches.get(stream, -1) >= number:
        return False
    batch = Warehouse(store.spark, store.root.rpartition("/")[0], store.root.rpartition("/")[2], uuid.uuid4().hex, store.buckets)
    found, seen = batch.stage_counted(fact.table.name, outcomes(fact, pages), **counts())
    written, _ = batch.prepare(fact.table, accepted(rows_of(found), fact.table), n_staged=seen["flattened"] - seen["rejected"])
    added = [written] if written else []
    if seen["broken"] + seen["invalid"] + seen["rejected"]:
        rejects = batch.stage("rejects", identified(set_aside(found, fact.table)))
        added.append(batch.write_plain(REJECTS, not_in_target(rejects, batch.read(REJECTS), list(REJECTS.key))))
    batch.publish(*added, batches={stream: number})
    batch.drop_staging(batch.run)
    return True


def insert_stream(store: Warehouse, fact: Fact, pages: DataFrame, checkpoint: str) -> StreamingQuery:
    """Loads the pages that have come in since the last call, then stops."""

    def load(batch: DataFrame, number: int) -> None:
        # A checkpoint keeps its query's id from the first start on.
        stream = json.loads(store.files.read(f"{checkpoint}/metadata"))["id"]
        insert_batch(store, fact, batch, stream, number)

    return (
        pages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_ingest(ctx: Context, fact: Fact, checkpoint: str, restaurant_guid=None, **source_options) -> StreamingQuery:
    """Loads what has landed for a tenant since the last call, then stops.

    `source_options` bound a batch, such as `maxFilesPerTrigger`.
    """
    restaurants = restaurants_of(ctx.tenants, ctx.tenant, restaurant_guid)
    pages = stream_pages(ctx.spark, ctx.landing, fact.endpoint, ctx.one_per_line, **source_options)
    return insert_stream(ctx.store, fact, in_restaurants(pages, restaurants), checkpoint)
