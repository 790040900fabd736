"""Row shapes shared by batch and stream, and the names found on the wire."""

from pyspark.sql import types as T

# Header names on the wire.
SEQ_NR = "akka-seq-nr"
MANIFEST = "akka-manifest"
SENDER = "akka-sender"
TAGS = "akka-tags"
WRITER_UUID = "akka-writer-uuid"
TIMESTAMP = "akka-timestamp"
SERIALIZER_ID = "akka-serializer-id"
SNAPSHOT_SEQ_NR = "akka-snapshot-seq-nr"
SNAPSHOT_TIMESTAMP = "akka-snapshot-timestamp"
TOMBSTONE_SEQ_NR = "akka-snapshot-tombstone-seq-nr"
TOMBSTONE_TIMESTAMP = "akka-snapshot-tombstone-timestamp"
TOMBSTONE_MAX_SEQ_NR = "akka-snapshot-tombstone-max-seq-nr"
TOMBSTONE_MIN_SEQ_NR = "akka-snapshot-tombstone-min-seq-nr"
TOMBSTONE_MAX_TIMESTAMP = "akka-snapshot-tombstone-max-timestamp"
TOMBSTONE_MIN_TIMESTAMP = "akka-snapshot-tombstone-min-timestamp"
CONTENT_TYPE = "content-type"

# Content types on the wire.
OPAQUE_TYPE = "application/x-hyperion"
JSON_TYPE = "application/json"
PROTOBUF_TYPE = "application/x-protobuf"

# Default topic names.
JOURNAL_TOPIC = "akka-journal"
INDEX_TOPIC = "akka-journal-index"
SNAPSHOT_TOPIC = "akka-snapshots"
TAG_TOPIC_PREFIX = "akka-journal-tag-"

# 100 ns ticks since 0001-01-01 at the Unix epoch, and at the end of year 9999.
UNIX_EPOCH_TICKS = 621355968000000000
MAX_TICKS = 3155378975999999999

MAX_LONG = 9223372036854775807

# Configured defaults.
DEFAULT_PARTITIONS = 16
REFRESH_INTERVAL = "250 milliseconds"
COMMIT_BATCH = 1000
COMMIT_INTERVAL = "5 seconds"

HEADERS = T.MapType(T.StringType(), T.BinaryType())

# ``seq_nr`` and ``tags`` repeat two headers and ``size`` the value's length, so that
# filters on them reach the parquet scan and leave headers and values unread. The
# first two are null for records that are not journal events.
TOPIC = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("seq_nr", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("size", T.IntegerType()),
    ]
)

# One row per topic partition that a batch wrote (``out``) or consumed (``in``).
COMMIT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("records", T.LongType()),
    ]
)

POSITION_KEYS = ["topic", "partition"]
ENTITY = ["topic", "persistence_id"]
