"""Large JSON files of one object with lists of records, read by many tasks at once.

A file ``{"nodes": [{...}, ...], "relationships": [...]}`` cannot be split at line ends. It is read in pieces that end
with a closing brace, and a first pass finds out for each split of the file how it changes the two things that the
next split has to know: whether a string is open, and how many brackets are. The second depends on the first, so both cases are
counted. A running sum over one row per split gives every split its true start, and a second pass cuts the records.
What a split holds of a record that began in an earlier one is put together by the split it began in; nothing else moves.

Defined results: a file without a list of that name, a null or an empty list give no record; other fields of the object, nested ones
included, are passed over; braces and quotes inside strings are text; several objects in a file are read one after
the other; a blank file is empty; an object that is cut off or closed too often fails, as does a list at the top.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from gleaner.session import materialise

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("?)|[][{]', re.DOTALL)
_BRACKET = re.compile(r"[][{]")
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
#: Open brackets inside a record: those of the object, of its list and of the record.
INSIDE = 3
#: Parts of a record that several splits hold, in the order in which one split can have them.
END, THROUGH, BEGIN = 0, 1, 2


def record_lists(spark: SparkSession, path: str) -> DataFrame:
    """(list, text): every record of every top-level list of the JSON files, as JSON text."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size")
    )
    # One row for each split, about 100 bytes for 128 MB of text: no size at which a broadcast of it matters.
    splits = materialise(split_starts(pieces), "splits").hint("broadcast")
    cut = materialise(_cut(pieces.drop("size").join(splits, ["file", "start"])), "records")
    before = W.Window.partitionBy("file").orderBy("start").rowsBetween(W.Window.unboundedPreceding, -1)
    last = cut.filter("kind = 'list'").select("file", "start", F.col("list").alias("ended_in"))
    named = splits.select("file", "start").join(last, ["file", "start"], "left").withColumn(
        "first_list", F.last("ended_in", ignorenulls=True).over(before)
    ).drop("ended_in").hint("broadcast")
    # The parts of a record that several splits hold follow its beginning, up to the first end.
    upto = W.Window.partitionBy("file").orderBy("start", "part").rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    parts = cut.filter("kind = 'part'").withColumn("of", F.sum((F.col("part") == BEGIN).cast("int")).over(upto)).filter("of > 0")
    grouped = parts.groupBy("file", "of").agg(F.array_sort(F.collect_list(F.struct("start", "part", "text", "list"))).alias("p"))
    end = F.array_position("p.part", F.lit(END))
    joined = grouped.filter(end > 0).select(
        "file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["list"].alias("list"),
        F.array_join(F.slice("p.text", F.lit(1), end.cast("int")), "").alias("text"),
    )
    whole = cut.filter("kind = 'record'").select("file", "start", "list", "text").unionByName(joined)
    return whole.join(named, ["file", "start"]).select(F.coalesce("list", "first_list").alias("list"), "text").filter("list <> ''")


def records(lists: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """The records of one list by a schema; a broken record fails the job that reads it."""
    found = lists.filter(F.col("list") == name)
    return found.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def split_starts(pieces: DataFrame) -> DataFrame:
    """(file, start, in_string, depth) of each split; a file whose brackets do not close fails."""
    changes = pieces.mapInArrow(_changes, "file string, start bigint, size bigint, flips int, plain int, inside int, bytes bigint")
    by_file = W.Window.partitionBy("file").orderBy("start")
    before, whole = by_file.rowsBetween(W.Window.unboundedPreceding, -1), W.Window.partitionBy("file")
    first = changes.withColumn("in_string", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    moved = first.withColumn("moves", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("plain")))
    ends = moved.withColumns({
        "depth": F.coalesce(F.sum("moves").over(before), F.lit(0)).cast("int"),
        # The last piece of a file has a closing brace of its own only if all bytes are accounted for.
        "open": F.sum("moves").over(whole) + F.when(F.sum("bytes").over(whole) > F.col("size"), 1).otherwise(0),
        "odd": F.sum("flips").over(whole) % 2,
    })
    broken = (F.col("open") != 0) | (F.col("odd") != 0)
    failure = F.raise_error(F.concat(F.lit("brackets or strings do not close in "), F.col("file")))
    return ends.select("file", "start", "in_string", F.when(broken, failure.cast("int")).otherwise(F.col("depth")).alias("depth"))


def _moves(text: str, in_string: bool) -> tuple[int, int, bool]:
    """Brackets that a piece opens without those it closes, begun outside and inside a string; whether the string state flips."""
    parts = _ESCAPED.sub("", text).split('"') if "\\" in text else text.split('"')
    flips = len(parts) % 2 == 0
    found = []
    for first in (0, 1):
        outside = "".join(parts[first::2])
        opened = outside.count("{") + outside.count("[") - outside.count("]")
        # The brace that ends the piece counts if no string is open there.
        found.append(opened - (flips == bool(first)))
    return found[in_string], found[not in_string], flips


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the depth, begun outside and inside a string."""
    now, held = None, [0, 0, 0, 0]

    def row() -> pa.RecordBatch:
        names = ["file", "start", "size", "flips", "plain", "inside", "bytes"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*now, *held], types, strict=True)], names)

    for batch in batches:
        for text, *split in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if split != now:
                if now:
                    yield row()
                now, held = split, [0, 0, 0, 0]
            plain, inside, flips = _moves(text, bool(held[0]))
            held = [held[0] ^ flips, held[1] + plain, held[2] + inside, held[3] + len(text.encode("utf-8", "surrogatepass")) + 1]
    if now:
        yield row()


def _dips(text: str, in_string: bool, depth: int) -> bool:
    """Whether a piece that begins inside a record closes more brackets than the record holds before its last brace."""
    for sign in _BRACKET.findall("".join(_ESCAPED.sub("", text).split('"')[in_string::2])):
        depth += -1 if sign == "]" else 1
        if depth < INSIDE:
            return True
    return False


class _Split:
    """The state inside a split while its records are cut."""

    def __init__(self, in_string: bool, depth: int) -> None:
        self.in_string, self.depth = in_string, depth
        self.list: str | None = None  # '': no list; None: that of the split before
        self.key = ""
        self.record = depth >= INSIDE  # as far as can be seen from here; nested lists are told apart when they end
        self.open: list[str] = []  # pieces of the record that is open
        self.begun = False  # whether it began here

    def take(self, text: str) -> str | None:
        """Read one piece; the record that it ends, as far as this split holds it."""
        at = 0
        if self.record and "]" in text and _dips(text, self.in_string, self.depth):
            self.record, self.begun, self.open = False, False, []
        if not self.record:
            at = self._between(text)
        if not self.record:
            if not self.in_string:
                self._close()
            return None
        body = text[at:]
        moves, _, flips = _moves(body, self.in_string)
        self.depth, self.in_string, self.record = self.depth + moves, self.in_string ^ flips, self.depth + moves >= INSIDE
        self.open.append(body + "}")
        if self.record:
            return None
        ended, self.open = "".join(self.open), []
        return ended

    def _between(self, text: str) -> int:
        """Walk over what is between records, up to the inside of the next one."""
        at = 0
        if self.in_string:
            end = _STRING_END.match(text)
            if not end:
                return len(text)
            self.in_string, at, self.key = False, end.end(), ""
        for token in _TOKEN.finditer(text, at):
            sign = token[0]
            if sign[0] == '"':
                self.in_string = not token[1]
                if self.depth == 1:
                    self.key = "" if self.in_string else json.loads(sign, strict=False)
            elif sign == "]":
                self._close()
            else:
                if self.depth == 0 and sign == "[":
                    raise ValueError("a file holds one object, not a list")
                self.depth += 1
                if self.depth == 2:
                    self.list = self.key if sign == "[" else ""
                if self.depth == INSIDE and sign == "{":
                    self.record, self.begun, self.open = True, True, [sign]
                    return token.end()
        return len(text)

    def _close(self) -> None:
        self.depth -= 1
        if self.depth == 1:
            self.list = ""


def _cut(pieces: DataFrame) -> DataFrame:
    """(file, start, kind, part, list, text) per split: whole records, parts of records, and the list that is open at the end."""
    fields = [("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("part", pa.int32()), ("list", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []

        def ended() -> Iterator[tuple]:
            if state.open:
                yield (*now, "part", BEGIN if state.begun else THROUGH, state.list if state.begun else None, "".join(state.open))
            if state.list is not None:
                yield (*now, "list", 0, state.list, None)

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])

        for batch in batches:
            for file, start, text, in_string, depth in zip(*(batch.column(n).to_pylist() for n in ("file", "start", "value", "in_string", "depth")), strict=True):
                if (file, start) != now:
                    if state:
                        rows += ended()
                    now, state = (file, start), _Split(in_string, depth)
                record = state.take(text)
                if record is not None:
                    rows.append((*now, "record", 0, state.list, record) if state.begun else (*now, "part", END, None, record))
                    state.begun = False
            if rows:
                yield flush()
                rows = []
        if state:
            rows += ended()
        if rows:
            yield flush()

    return pieces.mapInArrow(run, "file string, start bigint, kind string, part int, list string, text string")
