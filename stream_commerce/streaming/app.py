"""Start one job: `spark-submit ... -m stream_commerce.streaming.app JOB --store DIR ...`.

Messages come from Kafka (`--servers`) or, without a broker, from text files below
`--feeds DIR/WRITER/topic=NAME`, where each writing job has a folder of its own. Tables and
checkpoints live below `--store`, a shared folder.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stream_commerce import schemas
from stream_commerce.config import session_builder
from stream_commerce.functions.records import parse_json
from stream_commerce.sources import dimensions, topics
from stream_commerce.streaming import jobs, sinks

# Row changes arrive as JSON of the row-change schema on this topic.
CHANGE_TOPIC = "row_changes"


class App:
    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args = spark, args
        self.trigger = jobs.UNTIL_DRAINED if args.drain else jobs.TEN_SECONDS

    def _feed(self, topic: str) -> str:
        return f"{self.args.feeds}/*/topic={topic}"

    def _stream(self, topic: str, start: str) -> DataFrame:
        if self.args.servers:
            return topics.kafka_stream(self.spark, self.args.servers, topic, start)
        return topics.folder_stream(self.spark, self._feed(topic), topic)

    def _writer(self, rows: DataFrame) -> DataStreamWriter:
        if self.args.servers:
            return sinks.kafka_writer(rows, self.args.servers)
        return sinks.folder_writer(rows, f"{self.args.feeds}/{self.args.job}")

    def _path(self, name: str) -> str:
        return f"{self.args.store}/{name}"

    def _checkpoint(self, name: str) -> str:
        return self._path(f"checkpoints/{name}-{self.args.run}")

    def _changes(self) -> DataFrame:
        parsed = parse_json(self._stream(CHANGE_TOPIC, topics.EARLIEST), schemas.ROW_CHANGE)
        return parsed.select(*schemas.ROW_CHANGE.fieldNames())

    def diversion(self) -> StreamingQuery:
        raw = self._stream(schemas.BASE_LOG_TOPIC, topics.LATEST)
        return jobs.run_diversion(raw, self._writer, self._checkpoint("diversion"), self.trigger)

    def starts(self) -> StreamingQuery:
        table = jobs.start_table(self._path("starts"), self.args.run)
        return jobs.run_first_starts(
            self._starts(), table, self._checkpoint("starts"), self.trigger, on_unreadable=self._aside("starts"))

    def _starts(self) -> DataFrame:
        return self._stream(schemas.START_TOPIC, topics.EARLIEST)

    def openstarts(self) -> StreamingQuery:
        """As `starts`, with the devices of the last days only, kept as state."""
        table = jobs.first_start_table(self._path("openstarts"), self.args.run)
        return jobs.run_first_starts_state(
            self._starts(), table, self._checkpoint("openstarts"), self.args.days_open, self.trigger)

    def outsidestarts(self) -> StreamingQuery:
        """The starts that `openstarts` leaves out."""
        table = jobs.outside_start_table(self._path("outsidestarts"), self.args.run)
        marks = jobs.mark_table(self._path("outsidestarts-marks"), self.args.run)
        return jobs.run_outside_starts(
            self._starts(), table, marks, self._checkpoint("outsidestarts"), self.args.days_open, self.trigger)

    def _aside(self, name: str):
        return jobs.unreadable_table(self._path(f"unreadable/{name}"), self.args.run).write

    def badlogs(self) -> StreamingQuery:
        raw = self._stream(schemas.BASE_LOG_TOPIC, topics.LATEST)
        table = jobs.unreadable_table(self._path("unreadable/logs"), self.args.run)
        return jobs.run_unreadable_logs(raw, table, self._checkpoint("badlogs"), self.trigger)

    def gmv(self) -> StreamingQuery:
        stream = self._stream(schemas.ORDER_INFO_TOPIC, topics.EARLIEST)
        table = jobs.gmv_table(self._path("gmv"), self.args.run)
        aside = jobs.unreadable_order_table(self._path("unreadable/orders"), self.args.run)
        return jobs.run_gmv(
            stream, table, self._checkpoint("gmv"), self.trigger, once_within=self.args.once_within,
            on_unreadable=aside.write)

    def actions(self) -> StreamingQuery:
        table = jobs.action_table(self._path("actions"), self.args.actions_run)
        return jobs.run_action_log(
            self._stream(schemas.ACTION_TOPIC, topics.EARLIEST), table, self._checkpoint("actions"), self.trigger,
            self._aside("actions"))

    def alerts(self) -> StreamingQuery:
        """Needs the `actions` job, which keeps actions by their own time, however late they came."""
        kept = jobs.action_table(self._path("actions"), self.args.actions_run)
        return jobs.run_alerts(
            self._stream(schemas.ACTION_TOPIC, topics.LATEST),
            lambda spark, from_ms, to_ms: jobs.actions_between(spark, kept, from_ms, to_ms),
            jobs.alert_table(self._path("alerts"), self.args.run), self._checkpoint("alerts"),
            trigger=self.trigger, lateness=self.args.lateness,
        )

    def _users(self, spark: SparkSession) -> DataFrame:
        table = jobs.user_table(self._path("users"), self.args.users_run)
        return jobs.user_view(spark, table, self.args.now_ms or int(time.time() * 1000))

    def _provinces(self, spark: SparkSession) -> DataFrame:
        if self.args.provinces:
            return spark.read.parquet(self.args.provinces)
        return dimensions.jdbc_provinces(
            spark, self.args.jdbc_url, self.args.jdbc_user, self.args.jdbc_password,
            self.args.jdbc_driver,
        )

    def sales(self) -> StreamingQuery:
        table = jobs.sale_table(self._path("sales"), self.args.run)
        return jobs.run_sales(
            self._stream(schemas.ORDER_INFO_TOPIC, topics.LATEST),
            self._stream(schemas.ORDER_DETAIL_TOPIC, topics.LATEST),
            self._users, self._provinces, table, self._checkpoint("sales"),
            trigger=self.trigger,
        )

    def changes(self) -> StreamingQuery:
        # Files are committed once per batch; on Kafka a replayed batch is sent again and readers need the ids.
        return jobs.run_change_topics(
            self._changes(), self._writer, self._checkpoint("changes"), self.trigger, ids=bool(self.args.servers)
        )

    def users(self) -> StreamingQuery:
        table = jobs.user_table(self._path("users"), self.args.users_run)
        return jobs.run_user_state(
            self._changes(), table, self._checkpoint("users"), self.trigger
        )


JOBS = ["diversion", "badlogs", "starts", "openstarts", "outsidestarts", "gmv", "actions", "alerts", "sales", "changes", "users"]


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--store", required=True, help="shared folder for tables and checkpoints")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--feeds", help="folder with WRITER/topic=NAME folders of text files")
    parser.add_argument("--run", default="main", help="new name for each new checkpoint")
    parser.add_argument("--users-run", default="main", help="run of the user table, for users and sales")
    parser.add_argument("--actions-run", default="main", help="run of the action table, for actions and alerts")
    parser.add_argument("--once-within", default="1 day", help="an order id counts once within this time")
    parser.add_argument("--days-open", type=int, default=1, help="days before the newest whose devices openstarts still knows")
    parser.add_argument("--lateness", default="5 minutes", help="how late actions may come for alerts")
    parser.add_argument("--partitions", type=int, help="shuffle partitions; a query with state keeps its first value, "
                        "so size it for the state that all its keys will need, not for one batch")
    parser.add_argument("--drain", action="store_true", help="stop when all input is read")
    parser.add_argument("--provinces", help="Parquet table used instead of the database")
    parser.add_argument("--now-ms", type=int, help="time against which user rows expire")
    for name in ("url", "user", "password", "driver"):
        parser.add_argument(f"--jdbc-{name}")
    return parser.parse_args(argv)


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    if args.partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.partitions)
    return getattr(App(spark, args), args.job)()


def main() -> None:
    args = parse_args()
    start(session_builder(args.job).getOrCreate(), args).awaitTermination()


if __name__ == "__main__":
    main()
