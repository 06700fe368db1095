"""Fixed schemas of the records that move through the pipeline."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TOPIC_RECORD = _struct(
    value=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
)

READING = _struct(
    obs_key=T.StringType(),
    obs_ts=T.TimestampType(),
    arrival_ts=T.TimestampType(),
    temperature=T.DoubleType(),
    precipitation=T.DoubleType(),
)

# Stored window: the text columns are what SQL users and CSV exports see, the
# typed twins and the date exist so that time predicates reach the scan.
WINDOW_DOCUMENT = _struct(
    window_start=T.StringType(),
    window_end=T.StringType(),
    avg_timestamp=T.StringType(),
    avg_temperature=T.DoubleType(),
    avg_precipitation=T.DoubleType(),
    record_count=T.LongType(),
    processed_at=T.TimestampType(),
    window_start_ts=T.TimestampType(),
    window_date=T.DateType(),
)

# What the batch leg reads back from a CSV export; everything is text until cleaned.
WINDOW_CSV = _struct(
    window_start=T.StringType(),
    window_end=T.StringType(),
    avg_timestamp=T.StringType(),
    avg_temperature=T.StringType(),
    avg_precipitation=T.StringType(),
    record_count=T.StringType(),
    processed_at=T.StringType(),
)

SERIES = _struct(
    series_key=T.StringType(),
    ds=T.TimestampType(),
    y=T.DoubleType(),
    x=T.DoubleType(),
)

EVENTS = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

# What `traffic.Landing` adds to the readings that it lands.
LANDING_MARKS = _struct(
    level=T.IntegerType(),
    others=T.ArrayType(T.IntegerType()),
    late=T.BooleanType(),
    landed=T.LongType(),
)

# One file of a keyed store that a commit adds or removes.
FILE_ACTION = _struct(
    action=T.StringType(),
    path=T.StringType(),
    part=T.StringType(),
    seq=T.LongType(),
    version=T.LongType(),
    run=T.StringType(),
    batch_id=T.LongType(),
    n=T.LongType(),
    buckets=T.ArrayType(T.IntegerType()),
)
