"""Landing of webhook messages: every message received, batch by batch, apart from those that can't be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from guestbook.operators.dedupe import keep_one
from guestbook.streaming.incremental import BATCH

# The fields read from a message body.
BODY = "eventName string, dataFields struct<messageId: string>"

#: Column that says why a message can't be used, and its word for one that can.
FAULT = "fault"
NO_FAULT = "none"


def parse(messages: DataFrame, body: str = "body", at: str = "received_at") -> DataFrame:
    """Event name, message id and day beside the body, and what is wrong with the message.

    No message is left out: one that does not parse or lacks an id or a time comes with the first such ``fault``.
    """
    fields = F.from_json(F.col(body), BODY)
    name, number = fields.getField("eventName"), fields.getField("dataFields").getField("messageId")
    fault = (
        F.when(F.get_json_object(F.col(body), "$").isNull(), "unreadable")
        .when(name.isNull(), "no event name")
        .when(number.isNull(), "no message id")
        .when(F.col(at).isNull(), "no time")
        .otherwise(NO_FAULT)
    )
    return messages.select(
        name.alias("event_name"),
        number.alias("message_id"),
        F.col(at).alias("received_at"),
        F.to_date(F.col(at)).alias("event_date"),
        F.col(body).alias("body"),
        fault.alias(FAULT),
    )


def land_messages(messages: DataFrame, out: str, checkpoint: str) -> None:
    """Stream parsed messages to a folder for each batch and ``fault`` in it.

    Nothing is dropped, however late, so no state is kept and nothing is shuffled: every task of a batch writes what it has
    read, a file for each fault it met and not one for each event and day. A batch that is repeated after a failure replaces
    its folder. Repeats of a message are settled by :mod:`guestbook.streaming.compaction`, or by ``latest_messages``.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(FAULT)
        rows.parquet(f"{out}/{BATCH}={number}")

    query = (
        messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()


def landed_messages(spark: SparkSession, out: str) -> DataFrame:
    """The messages that can be used; the folders of the others aren't opened."""
    return spark.read.parquet(out).where(F.col(FAULT) == NO_FAULT).drop(FAULT, BATCH)


def faulty_messages(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).where(F.col(FAULT) != NO_FAULT).drop(BATCH)


def latest_messages(landed: DataFrame, tie: Column | None = None) -> DataFrame:
    """The last copy of each message of a day wins."""
    order = [F.col("received_at").desc_nulls_last(), tie if tie is not None else F.col("body").asc_nulls_last()]
    return keep_one(landed, ["event_name", "message_id", "event_date"], order)
