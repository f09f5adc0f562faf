"""Declared schemas of every table and message the library reads or writes."""

from pyspark.sql import types as T

GROUP = ["dept_name", "zone", "time_of_day", "season"]

RECORDING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dept_name", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("time_of_day", T.StringType()),      # HH:MM:SS
    T.StructField("date_of_event", T.StringType()),    # YYYY-MM-DD
    T.StructField("duration", T.DoubleType()),         # minutes
    T.StructField("text", T.StringType()),
])

VIEW = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("dept_name", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("time_of_day", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("most_common_words", T.StringType()),
    T.StructField("least_common_words", T.StringType()),
    T.StructField("sentiment_score_sum", T.LongType()),
    T.StructField("sentiment_score_total", T.LongType()),
])

REVIEW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("score", T.IntegerType()),
])

MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("body", T.StringType()),
])

UPLOAD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dept_name", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("duration", T.StringType()),         # a form field, so text
    T.StructField("text", T.StringType()),
    T.StructField("recording", T.BooleanType()),
])

TRANSCRIPT = T.StructType([
    T.StructField("jobName", T.StringType()),
    T.StructField("results", T.StructType([
        T.StructField("transcripts", T.ArrayType(T.StructType([
            T.StructField("transcript", T.StringType()),
        ]))),
    ])),
])

STORAGE_EVENT = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
        ])),
    ]))),
])

CORRUPT = "_corrupt_record"


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which Spark keeps records it could not parse."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
