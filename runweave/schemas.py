"""Table schemas and fixed values of the data model."""

from pyspark.sql import types as T

# --- fixed values: enum names by number -------------------------------------
VALUE_TYPE = {0: "UNSET", 1: "NUMBER", 2: "STRING"}

# --- fixed values: names and limits ------------------------------------------
KEY_PATTERN = r"^[a-zA-Z0-9_\-\.]+$"
KEY_SEPARATOR = "."
DEFAULT_IGNORE = ["__pycache__/", "venv/", ".git/", ".vscode/"]
DEFAULT_CONTENT_TYPE = "application/octet-stream"
UNLOGGED_PATHS = ["/", "/metadata"]
HEARTBEAT_SECONDS = 60
MAX_POLLS = 600
# -----------------------------------------------------------------------------

NUMBER, STRING = 1, 2
EXPERIMENT, LIVE = 1, 2
RUNNING, COMPLETED, FAILED = 1, 2, 3
LOCAL, JOB, SERVING = 0, 1, 2
FILE, FOLDER = 1, 2

LOGS = T.StructType(
    [
        T.StructField("workspace_id", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("tracker_id", T.StringType()),
        T.StructField("log_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("number", T.MapType(T.StringType(), T.FloatType())),
        T.StructField("text", T.MapType(T.StringType(), T.StringType())),
    ]
)

# A record as it travels: keys and values in parallel arrays.
WIRE_LOGS = T.StructType(
    [
        T.StructField("workspace_id", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("tracker_id", T.StringType()),
        T.StructField("log_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("number_keys", T.ArrayType(T.StringType())),
        T.StructField("number_values", T.ArrayType(T.FloatType())),
        T.StructField("text_keys", T.ArrayType(T.StringType())),
        T.StructField("text_values", T.ArrayType(T.StringType())),
    ]
)

LOG_LINE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("levelname", T.StringType()),
        T.StructField("logtype", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField(
            "log",
            T.StructType(
                [
                    T.StructField(
                        "code",
                        T.StructType(
                            [
                                T.StructField("file", T.StringType()),
                                T.StructField("line", T.IntegerType()),
                            ]
                        ),
                    ),
                    T.StructField("data", T.VariantType()),
                    T.StructField("lines", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

TRACE_NODE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
