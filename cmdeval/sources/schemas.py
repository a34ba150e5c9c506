"""Declared schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

PAIR_SCHEMA = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("command", T.StringType()),
])

SUITE_SCHEMA = T.StructType([
    T.StructField("suite", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("nl", T.StringType()),
    T.StructField("gold", T.StringType()),
])

RESPONSE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("suite", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("raw_prediction", T.StringType()),
    T.StructField("latency", T.DoubleType()),
    # Optional in a dump: null where it has none.
    T.StructField("is_error", T.BooleanType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("error", T.StringType()),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("loss", T.DoubleType()),
])

GPU_SAMPLE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("label", T.StringType()),
    T.StructField("reserved_bytes", T.LongType()),
    T.StructField("total_bytes", T.LongType()),
])
