"""Trip messages: JSON text to typed trips, with unusable messages set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.payment import CASH, CREDIT, variant_is
from wayfare.functions.times import iso_timestamp

# Message fields. The two short time names are aliases of the long ones.
_TEXT_FIELDS = (
    "tpep_pickup_datetime",
    "pickup_datetime",
    "tpep_dropoff_datetime",
    "dropoff_datetime",
    "pickup_zone",
    "dropoff_zone",
    "producer_timestamp",
)
_NUMBER_FIELDS = {
    "passenger_count": "int",
    "trip_distance": "double",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "duration_minutes": "double",
}

# Numbers are read as text: a number in quotes is a number too, and one bad field must not
# blank out the fields after it.
_SCHEMA = ", ".join(
    [f"{c} STRING" for c in (*_TEXT_FIELDS, *_NUMBER_FIELDS)]
    + ["payment_type VARIANT", "_malformed STRING"]
)
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _number(name: str, type_name: str) -> str:
    number = f"try_cast(_m.{name} AS DOUBLE)"
    return number if type_name == "double" else f"try_cast({number} AS {type_name})"


def parse_messages(
    messages: DataFrame, value: str = "value", event_column: str | None = None
) -> DataFrame:
    """Add typed trip columns and ``reject_reason`` (null for a usable message).

    A message without a readable ``event_column`` (bad or absent time) is not usable where that
    column is named, since no window can hold it. Unknown fields are ignored; other input
    columns are kept. The JSON text is parsed once: behind a generator Spark does not copy
    the parsing into every filter above it.
    """
    options = ", ".join(f"'{k}', '{v}'" for k, v in _OPTIONS.items())
    parsed = f"from_json({value}, '{_SCHEMA}', map({options}))"
    bad_number = " OR ".join(
        f"coalesce(trim(_m.{n}) <> '' AND {_number(n, t)} IS NULL, false)"
        for n, t in _NUMBER_FIELDS.items()
    )
    pickup = "coalesce(_m.tpep_pickup_datetime, _m.pickup_datetime)"
    dropoff = "coalesce(_m.tpep_dropoff_datetime, _m.dropoff_datetime)"
    times = {
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": dropoff,
        "producer_timestamp": "_m.producer_timestamp",
    }
    bad_time = ""
    if event_column:
        text = times[event_column]
        bad_time = f"""
            WHEN {text} IS NULL OR trim({text}) = '' THEN 'missing_event_time'
            WHEN {iso_timestamp(text)} IS NULL THEN 'bad_event_time'"""
    return messages.selectExpr("*", f"inline(array(named_struct('_m', {parsed})))").selectExpr(
        *messages.columns,
        f"{iso_timestamp(pickup)} AS tpep_pickup_datetime",
        f"{iso_timestamp(dropoff)} AS tpep_dropoff_datetime",
        *[f"{_number(n, t)} AS {n}" for n, t in _NUMBER_FIELDS.items()],
        f"{variant_is('_m.payment_type', CREDIT)} AS is_credit",
        f"{variant_is('_m.payment_type', CASH)} AS is_cash",
        "_m.pickup_zone AS pickup_zone",
        "_m.dropoff_zone AS dropoff_zone",
        f"{iso_timestamp('_m.producer_timestamp')} AS producer_timestamp",
        f"""CASE WHEN {value} IS NULL OR trim({value}) = '' THEN 'empty_message'
            WHEN _m._malformed IS NOT NULL THEN 'malformed_json'
            WHEN {bad_number} THEN 'bad_number'{bad_time} END AS reject_reason""",
    )


def usable(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.filter("reject_reason IS NULL").drop("reject_reason", value)


def rejected(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The unusable messages, as they came in, with the reason."""
    return parsed.filter("reject_reason IS NOT NULL").select(value, "reject_reason")


def fail_on_rejects(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Strict form of :func:`usable`: the first unusable message fails the job."""
    reason = F.col("reject_reason")
    failure = F.raise_error(F.concat(F.lit("unusable message: "), reason))
    checked = parsed.filter(F.when(reason.isNotNull(), failure.cast("boolean")).otherwise(True))
    return checked.drop("reject_reason", value)


def with_publish_fields(trips: DataFrame) -> DataFrame:
    """Stamp the time of publication and the message key, which is the pickup zone."""
    return trips.withColumns(
        {"producer_timestamp": F.current_timestamp(), "partition_key": F.col("pickup_zone")}
    )


def kafka_options(
    brokers: str,
    topic: str,
    group: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the reader. Messages that expired before they were read fail the stream
    unless ``fail_on_data_loss`` is off."""
    limit = {"maxOffsetsPerTrigger": str(offsets_per_trigger)} if offsets_per_trigger else {}
    return {
        **limit,
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of message texts. Needs the Kafka connector on the cluster's class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of message texts from files with one message per line."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
