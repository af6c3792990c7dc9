"""What became of each page, document and row, from one parse.

Pages are parsed once. Every document, and every page that cannot be read, is tagged before it is
flattened; flattening keeps the tag. The result has the target columns of a table and

    reject_reason   why it was set aside, null when it was not
    stage           row, document (gave no row) or page (cannot be read)
    n_documents     1 on the first outcome of each document, else 0
    record          the page or document as JSON, where that was set aside
    query_date      the day the page was asked for, where pages have one

so rows, rejects and all counters can be read from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.values import filled
from tillhouse.operators.enforce import REASON, enforce
from tillhouse.schemas import Table

TAG = "_outcome"
COLUMNS = ["stage", "n_documents", "record"]
QUERY_DAY = "query_date"


def tag(docs: DataFrame, header: list[str]) -> DataFrame:
    """Marks rows of `documents_and_pages` with their stage, reason and record.

    `reject_reason` is the document's; of a rejected document the `header` columns are kept.
    """
    page = F.col("page_error").isNotNull()
    reason = F.coalesce("page_error", REASON)
    place = [c for c in ("restaurant_guid", QUERY_DAY, "source_file") if c in docs.columns]
    of_page = F.to_json(F.struct(*place, "value"))
    of_document = F.to_json(F.struct(*place, *[c for c in header if c in docs.columns]))
    return docs.withColumn(
        TAG,
        F.struct(
            F.when(page, "page").otherwise("document").alias("stage"),
            reason.alias("reason"),
            F.when(page, of_page).when(reason.isNotNull(), of_document).alias("record"),
        ),
    )


def is_tagged(docs: DataFrame) -> bool:
    return TAG in docs.columns


def passing(docs: DataFrame) -> list[str]:
    """The columns that flattening hands on."""
    return [TAG, *([QUERY_DAY] if QUERY_DAY in docs.columns else [])]


def sound() -> Column:
    """Whether there is a document and nothing against it."""
    return F.col(TAG)["reason"].isNull()


def settle(flat: DataFrame, table: Table, defects: list[Column], first: Column | None = None, is_row: Column | None = None) -> DataFrame:
    """Enforced rows of a table with what became of their documents.

    `first` says which is the first of a document, when that can have several; `is_row` which are
    rows at all, beside having their keys.
    """
    first = F.lit(True) if first is None else first
    keys = [filled(F.col(k).cast("string")) for k in table.key]
    row = reduce(lambda a, b: a & b, keys, sound() if is_row is None else sound() & is_row)
    marked = flat.withColumns({"_first": first, "_row": row})
    carried = passing(flat)
    enforced = enforce(marked, table, [*carried, "_first", "_row"], defects)
    told, is_document = F.col(TAG), F.col(TAG)["stage"] == "document"
    return enforced.where(F.col("_row") | F.col("_first")).select(
        *[c for c in table.columns],
        F.when(F.col("_row"), F.col(REASON)).otherwise(told["reason"]).alias(REASON),
        F.when(F.col("_row"), "row").otherwise(told["stage"]).alias("stage"),
        F.when(F.col("_first") & is_document, 1).otherwise(0).alias("n_documents"),
        F.when(~F.col("_row"), told["record"]).alias("record"),
        *[c for c in carried if c != TAG],
    )


def rows_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("stage") == "row")


def set_aside(outcomes: DataFrame, table: Table) -> DataFrame:
    """Rejects of all three stages: `table_name, stage, restaurant_guid, reject_reason, record`."""
    # Without the load stamp: the same row set aside again is the same reject.
    of_row = F.to_json(F.struct(*[c for c in table.columns if c != "_loaded_at"]))
    return outcomes.where(F.col(REASON).isNotNull()).select(
        F.lit(table.name).alias("table_name"),
        "stage",
        "restaurant_guid",
        REASON,
        F.when(F.col("stage") == "row", of_row).otherwise(F.col("record")).alias("record"),
    )


def counts() -> dict[str, Column]:
    """Aggregates that a run is summed up by."""
    at = lambda stage: F.col("stage") == stage
    bad = F.col(REASON).isNotNull()
    return {
        "fetched": F.sum("n_documents"),
        "broken": F.count_if(at("page")),
        "invalid": F.count_if(at("document") & bad),
        "flattened": F.count_if(at("row")),
        "rejected": F.count_if(at("row") & bad),
    }
