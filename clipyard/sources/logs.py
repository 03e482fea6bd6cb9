"""Log events: formatted text lines and JSON messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The log line layout, in characters.
#   yyyy-MM-dd HH:mm:ss.SSS | LEVEL | thread     | class               :line  | message
LINE_FORMAT = (
    "^\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d\\.\\d{3} \\| .{5} \\| .{10} \\| .{20}:.{5} \\| "
)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
LAYOUT = {
    "ts": (1, 23),
    "level": (27, 5),
    "thread": (35, 10),
    "class": (48, 20),
    "line_no": (69, 5),
    "message": (77, 1 << 30),
}
# Fixed value: the tag put on events of the JSON input.
JSON_TAG = "docker-elk"


def format_line(ts, level, thread, klass, line_no, message) -> Column:
    """A log line in the fixed layout; a longer field keeps its end, as loggers cut names."""

    def fit(name, column):
        return F.rpad(F.right(column, F.lit(LAYOUT[name][1])), LAYOUT[name][1], " ")

    place = F.concat(fit("class", klass), F.lit(":"), fit("line_no", line_no))
    head = [F.date_format(ts, TIMESTAMP_FORMAT), fit("level", level), fit("thread", thread)]
    return F.concat_ws(" | ", *head, place, message)


def parse_lines(lines: DataFrame, line: str = "value", *keep: str) -> DataFrame:
    """Lines split into ``ts, level, thread, class, line_no, message``.

    Works on batches and streams. All fields have fixed widths: one pattern checks
    the layout, substrings do the rest. A line of another shape keeps null fields.
    """
    matches = F.col(line).rlike(LINE_FORMAT)
    fields = {
        name: F.when(matches, F.substring(line, start, width)) for name, (start, width) in LAYOUT.items()
    }
    trimmed = {n: c if n == "message" else F.rtrim(c) for n, c in fields.items()}
    trimmed["ts"] = fields["ts"].try_cast(T.TimestampNTZType())
    return lines.select(*keep, F.col(line).alias("line"), *[c.alias(n) for n, c in trimmed.items()])


def line_stream(spark, folder: str, **options) -> DataFrame:
    """Log lines arriving as text files in a folder, one event per line."""
    return spark.readStream.options(**options).text(folder)


def json_events(lines: DataFrame, schema, value: str = "value", tag: str = JSON_TAG, *keep) -> DataFrame:
    """JSON log events as columns plus a ``tags`` array."""
    event = lines.select(*keep, F.from_json(value, schema).alias("e"))
    return event.select(*keep, "e.*", F.array(F.lit(tag)).alias("tags"))
