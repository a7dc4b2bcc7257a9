"""JSON messages -> rows.  Everything here works on streams and on batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import finite, read_number
from ..schemas import PAYLOAD_SCHEMA

CORRUPT = "_corrupt_record"


def parse_messages(
    df: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Fields of every message plus ``_corrupt_record``, which holds the text of unreadable ones.

    ``keep`` names columns of the input to carry along, such as the broker's timestamp.  The
    fields come out of a generator, so filters on them do not parse the message a second time.
    Numbers may come as text; one that cannot be read is null and does not spoil its message.
    """
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    as_read = [T.StructField(f.name, T.StringType()) if f.name in numbers else f for f in schema.fields]
    with_corrupt = T.StructType([*as_read, T.StructField(CORRUPT, T.StringType())])
    text = F.col(value_col).cast("string")
    data = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = df.select(*keep, F.inline(F.array(data)))
    read = fields.withColumns({name: read_number(fields, name) for name in numbers})
    return read.withColumns({name: finite(F.col(name)) for name in numbers})


def identified(id_col: str) -> Column:
    return F.length(F.trim(F.coalesce(F.col(id_col), F.lit("")))) > 0


def valid_messages(parsed: DataFrame, id_col: str = "video_id") -> DataFrame:
    """Readable messages with an id that is not blank; none of them is among the rejected ones."""
    return parsed.filter(identified(id_col) & F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_messages(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Texts of messages that are not JSON of the schema, for a dead-letter table."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, *keep)
