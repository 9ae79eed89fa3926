"""The medallion chain as batch DataFrame plans.

messages -> bronze (decode) -> silver (validate + dedup) -> gold (metrics).
The same layer functions back the streaming jobs in ``tidemark.streaming``;
here nothing is materialised, so Catalyst sees one plan from scan to result
and prunes columns / pushes filters through every layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode
from ..operators.dedup import dedup, precombine
from ..operators.metrics import order_metrics, user_metrics
from ..operators.validate import validate
from ..schemas import GOLD_WATERMARK, ORDER_TOPIC, SILVER_WATERMARK, USER_TOPIC
from ..session import ensure_utc, stored
from ..sources.testdata import raw_messages

ARRIVAL_ORDER = ("kafka_timestamp", "partition", "offset")


def to_silver(bronze: DataFrame, delay: str = SILVER_WATERMARK, unbounded: bool = False,
              keys: tuple[str, ...] = ("event_id",), precombine_copies: bool = False) -> DataFrame:
    """Watermark -> validate -> dedup. Batch: first arrival wins.

    ``precombine_copies`` (streams): drop repeated copies inside each input
    partition before the dedup shuffle (see ``operators.dedup.precombine``);
    it runs after validation so an invalid copy never shadows a valid one.
    """
    if precombine_copies and bronze.isStreaming:
        df = precombine(validate(bronze), keys).withWatermark("event_time", delay)
    else:
        df = validate(bronze.withWatermark("event_time", delay))
    return dedup(df, keys, order_by=None if df.isStreaming else ARRIVAL_ORDER,
                 unbounded=unbounded)


def only_topic(df: DataFrame, topic: str) -> DataFrame:
    return df.where(F.col("topic") == topic)


class Layers:
    """Lazy layer DataFrames over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    def messages(self) -> DataFrame:
        return raw_messages(self.spark, self.sf_dir)

    def bronze(self, parse_once: bool = False) -> DataFrame:
        return decode(self.messages(), parse_once=parse_once)

    def valid(self) -> DataFrame:
        return validate(self.bronze(parse_once=True))

    def silver(self) -> DataFrame:
        # one dedup over both topics keyed by (topic, event_id): identical to a
        # per-topic dedup, with a single shuffle
        return to_silver(self.bronze(parse_once=True), keys=("topic", "event_id"))

    def stored(self, df: DataFrame, label: str = "silver") -> DataFrame:
        """``df`` written once to the shared folder and read back.

        For plans that use a layer several times: each use scans columnar
        parquet (pruned, filters pushed) instead of re-decoding the messages,
        and the lineage is cut, so a lost executor recomputes from the table.
        """
        return stored(self.spark, df, label)

    def silver_user(self) -> DataFrame:
        return only_topic(self.silver(), USER_TOPIC)

    def silver_order(self) -> DataFrame:
        return only_topic(self.silver(), ORDER_TOPIC)

    def user_gold(self, window: str = "1 minute", distinct: str = "approx") -> DataFrame:
        return user_metrics(self.silver_user().withWatermark("event_time", GOLD_WATERMARK),
                            window, distinct)

    def order_gold(self, window: str = "1 minute", distinct: str = "approx") -> DataFrame:
        return order_metrics(self.silver_order().withWatermark("event_time", GOLD_WATERMARK),
                             window, distinct)
