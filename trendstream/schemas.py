"""Fixed schemas of the data that flows between the stages."""

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType,
                               IntegerType, LongType, MapType, StringType,
                               StructField, StructType, TimestampType)

# A post as read from a message file or a search (epoch-millis timestamp).
MESSAGE = StructType([
    StructField("text", StringType()),
    StructField("timestamp", LongType()),
    StructField("source", StringType()),
    StructField("numOfShares", IntegerType()),
    StructField("numOfLikes", IntegerType()),
    StructField("isShareOrRetweet", BooleanType()),
    StructField("lang", StringType()),
    StructField("id", LongType()),
    StructField("reactions", MapType(StringType(), IntegerType())),
    StructField("topics", ArrayType(StringType())),
    StructField("sentiment", DoubleType()),
])

# Primitive fields that a message file may omit; they default to 0 / false.
MESSAGE_PRIMITIVE_DEFAULTS = {
    "timestamp": 0, "numOfShares": 0, "numOfLikes": 0,
    "isShareOrRetweet": False, "id": 0, "sentiment": 0.0,
}

# Raw topic event: UTF-8 text of a post plus broker arrival time, and the
# message's key (post id) when its producer knows one.
RAW = StructType([
    StructField("body", BinaryType()),
    StructField("enqueuedTime", TimestampType()),
    StructField("key", StringType()),
])

# Enriched topic event, the JSON payload between enrichment and consumers;
# ``id`` only where the raw event had a key.
ENRICHED = StructType([
    StructField("content", StringType()),
    StructField("timestamp", StringType()),
    StructField("language", StringType()),
    StructField("entities", ArrayType(StringType())),
    StructField("id", StringType()),
])

# Narrow view of ENRICHED for the trend branch (only what it reads).
ENRICHED_TRENDS = StructType([
    StructField("timestamp", StringType()),
    StructField("entities", ArrayType(StringType())),
])

# Alert payload; the window bounds travel as 'yyyy-MM-dd HH:mm:ss' text.
ALERT = StructType([
    StructField("windowStart", StringType()),
    StructField("windowEnd", StringType()),
    StructField("topic", StringType()),
    StructField("count", LongType()),
])

# The same with every field as text: one bad field doesn't cost the others.
ALERT_TEXT = StructType([StructField(f.name, StringType()) for f in ALERT.fields])

# History table DDL (column sizes of the original SQL table).
HISTORY_DDL = ("UniqueId VARCHAR(37), TweetTime TIMESTAMP, Content STRING, "
               "Language VARCHAR(10), Topic VARCHAR(255)")

# Replies of the language and entity services.
LANGUAGE_REPLY = StructType([
    StructField("documents", ArrayType(StructType([
        StructField("id", StringType()),
        StructField("detectedLanguages", ArrayType(StructType([
            StructField("name", StringType()),
            StructField("iso6391Name", StringType()),
            StructField("score", DoubleType()),
        ]))),
    ]))),
])

# Entities of a document are a list or one object: kept as JSON text until both are read alike.
ENTITIES_REPLY = "documents array<struct<id:string,entities:string>>"
