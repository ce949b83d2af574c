"""Declared schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DOCUMENT = _struct(doc_id=T.StringType(), page_content=T.StringType(), metadata=STRING_MAP)

GOLDEN = _struct(
    user_input=T.StringType(),
    reference_contexts=T.ArrayType(T.StringType()),
    reference=T.StringType(),
)

TEST_EXAMPLE = _struct(
    question_id=T.StringType(),
    question=T.StringType(),
    context=T.ArrayType(T.StringType()),
    answer=T.StringType(),
)

# Every key a test-set file may carry; absent keys read as NULL.
TEST_SET_ROW = _struct(
    id=T.StringType(),
    text=T.StringType(),
    question=T.StringType(),
    user_input=T.StringType(),
    context=T.ArrayType(T.StringType()),
    documents=T.ArrayType(T.StringType()),
    reference_contexts=T.ArrayType(T.StringType()),
    answer=T.StringType(),
    reference=T.StringType(),
    answers=_struct(text=T.ArrayType(T.StringType())),
)

TEST_SET_FILE = _struct(examples=T.ArrayType(TEST_SET_ROW))

NODE = _struct(id=T.StringType(), type=T.StringType(), properties=STRING_MAP)

RELATIONSHIP = _struct(
    source=T.StringType(), target=T.StringType(), type=T.StringType(), properties=STRING_MAP
)

RUN_EVENT = _struct(
    event_id=T.LongType(),
    ts=T.TimestampType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

REVIEW_METADATA = ["Review_Date", "Review_Title", "Review_Url", "Author", "Rating"]
