"""IO1-IO4: connection-record CSV, scoring CSV, telemetry text log, live telemetry feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values that must equal the reference's: the 43 connection-record
# columns in file order (41 features, attack, difficulty).
CONNECTION_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
    "attack", "difficulty",
]
CATEGORICAL_COLUMNS = ["protocol_type", "service", "flag"]


def connection_schema() -> T.StructType:
    """Explicit types: never infer on a 100 TB CSV."""
    fields = []
    for name in CONNECTION_COLUMNS:
        if name in CATEGORICAL_COLUMNS or name == "attack":
            t = T.StringType()
        elif name.endswith("_rate"):
            t = T.DoubleType()
        elif name == "difficulty":
            t = T.IntegerType()
        else:
            t = T.LongType()
        fields.append(T.StructField(name, t, True))
    return T.StructType(fields)


FEATURE_COLUMNS = CONNECTION_COLUMNS[:-2]


def read_connections(spark: SparkSession, path: str) -> DataFrame:
    """IO1: headerless CSV with the imposed 43-column schema."""
    return (spark.read.schema(connection_schema()).option("header", False)
            .option("mode", "PERMISSIVE").csv(path))


def read_scoring(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """IO2: headered CSV of records to score (features only, or with label)."""
    if schema is None:
        schema = T.StructType([f for f in connection_schema().fields
                               if f.name in FEATURE_COLUMNS])
    return spark.read.option("header", True).schema(schema).csv(path)


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """IO3: telemetry text log -> (ts, epoch, vars) via TX1."""
    from ..functions.text import parse_telemetry
    return parse_telemetry(spark.read.text(path), "value")


def stream_telemetry(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """IO4: live feed = a directory of appended log files (no socket source)."""
    from ..functions.text import parse_telemetry
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_telemetry(r.load(directory), "value")
