"""Quality rules: counting rules with DataFrame functions, and a hashed n-gram log-likelihood ratio.

Every document gets counts that simple rules judge, and the mean log-likelihood ratio of its hashed token n-grams
between two multinomials: one over the trusted target documents, one over the whole corpus. Both are counted over
all documents; each document is then kept or not by one threshold, that many spreads below the median of the documents
that pass the base rules, so the verdict on a text depends on the corpus and the text alone.

* ``n_repeat_words``: words inside windows of eight words that occur at least twice in the text. Windows are
  compared by a 64-bit hash within one document.
* A document fails the base rules with fewer than 20 words, or with more than 30 % repeated words.
* Tokens are runs of letters and digits, and runs of other visible characters; n-grams are tokens and pairs of
  neighbours, counted by the cell their hash falls in, with add-one smoothing over the cells. The number of cells follows
  the characters of the corpus (``CHARS_A_CELL``), so no more n-grams share a cell in a large corpus than in a small one; ``buckets=None`` in the functions below counts each n-gram by its whole 64-bit hash.

Everything that the registered query runs is DataFrame functions. With cells, n-grams are counted by one aggregation by
cell; up to ``ARRAY_CELLS`` the weights are arrays of neighbouring cells, broadcast and looked up where the n-gram is cut, and
only one partial sum a document moves. A larger table of weights is joined to the n-grams of the texts. The same
counts and sums in numpy over Arrow batches (``arrow=True``) move less between tasks, and tests hold both equal.

Defined results: null and empty texts have no words, fail the base rules and score 0; repeated rows are judged
alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import BROADCAST_IDS, map_batches
from gleaner.session import materialise, setting

SYMBOLS = "[#*$%&|<>]"
TOKEN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]+"
_TOKEN = re.compile(r"\w+|[^\w \t-\r]+")  # the same
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
#: Characters of the corpus for each cell, and the least number of cells.
CHARS_A_CELL = 192
LEAST_CELLS = 1 << 16
#: Cells of the largest array of weights (two bytes each).
ARRAY_CELLS = 1 << 24
#: Neighbouring cells whose n-grams are listed together: a place among them and the mark of the target fit in two bytes.
SPAN = 1 << 15
#: Share of the documents by which frequent cells are found, and how often the share of a span a cell must have.
SAMPLE, SHARE = 0.01, 1024
#: Lists of that many keys are collected in memory (a task's n-grams, about 24 bytes each); with more keys they are sorted.
LISTS_IN_MEMORY = ("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 1 << 20)
#: Neighbouring cells of a list of weights.
LIST = 1 << 12
#: Cells of a piece: at least and at most.
PIECE = (1 << 15, 1 << 20)
#: N-grams that a task holds before it sends their counts on, and tokens of a text that are cut at once.
HELD = 6_000_000
BLOCK = 1 << 16
#: N-grams that are looked up without a join: the most frequent one of each slot. Changes no result.
SLOTS = 1 << 16
#: Weights are whole numbers of this fraction.
UNIT = 1000
#: A text is kept down to this many spreads (median distances from the median) below the median ratio.
SPREADS = 2
#: Least spread in units of 1 / ``UNIT``: a corpus of copies has none of its own.
LEAST_SPREAD = 150


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    # Other blanks become spaces, as texts are split at one given character many times faster than at a pattern.
    split = docs.withColumn("_split", F.split(F.regexp_replace(body, "[\\t-\\r]", " "), " ")).withColumn("_lines", lines)
    split = split.withColumn("_words", F.array_remove("_split", ""))
    paired = split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": (F.length(body) - (F.size("_split") - 1)).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_pairs": F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1))),
    }).drop("_split", "_words", "_lines")
    # The hash of a window is that of its four pairs of words: no window is put together as words.
    part = lambda size: F.slice("_pairs", F.lit(1), F.greatest(F.size("_pairs") - (size - 1), F.lit(0)))
    joined = lambda *at: lambda h, i: F.xxhash64(h, *(F.get("_pairs", i + k) for k in at))
    # Only documents in which half a window occurs twice get their windows hashed, and of these those with a window twice get them sorted.
    halves = paired.withColumn("_halves", F.transform(part(WINDOW // 2), joined(2)))
    twice = F.size(F.array_distinct("_halves")) < F.size("_halves")
    hashed = halves.withColumn("_windows", F.when(twice, F.transform(part(WINDOW), joined(2, 4, 6)))).drop("_pairs", "_halves")
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    repeated = hashed.withColumn(
        "_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered)
    )
    again = lambda s, k: (s["h"] == F.get("_sorted", k - 1)["h"]) | (s["h"] == F.get("_sorted", k + 1)["h"])
    starts = F.array_sort(F.transform(F.filter("_sorted", lambda s, k: F.coalesce(again(s, k), F.lit(False))),
                                      lambda s: s["i"]))
    covered = repeated.withColumn("_starts", starts)
    step = F.transform("_starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(WINDOW))))
    total = F.when(F.col("_starts").isNull(), 0).otherwise(F.aggregate(step, F.lit(0), lambda a, x: a + x))
    counted = covered.withColumn("n_repeat_words", total.cast("long")).drop("_windows", "_sorted", "_starts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def cells(text: Column, buckets: int | None = None) -> Column:
    """The hashes of all tokens and of all pairs of neighbours of a text (an array column of tokens)."""
    whole = lambda *parts: F.xxhash64(*parts)
    cell = whole if buckets is None else lambda *parts: F.pmod(whole(*parts), F.lit(buckets))
    pairs = F.transform(F.slice(text, F.lit(2), F.greatest(F.size(text) - 1, F.lit(0))), lambda t, i: cell(F.get(text, i), t))
    return F.concat(F.transform(text, lambda t: cell(t)), pairs)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def found_cells(docs: DataFrame, buckets: int | None) -> DataFrame:
    """``docs`` with the array ``_cells``."""
    return docs.withColumn("_t", tokens(F.col("text"))).withColumn("_cells", cells(F.col("_t"), buckets)).drop("_t")


def cell_rows(docs: DataFrame, buckets: int | None, *names: str) -> DataFrame:
    """(``names``, cell): the hashes of all tokens of a text and of all pairs of neighbours; null rows tell of texts that have none."""
    cell = lambda *parts: F.xxhash64(*parts) if buckets is None else F.pmod(F.xxhash64(*parts), F.lit(buckets))
    cut_up = docs.withColumn("_t", tokens(F.col("text"))).withColumn("_u", F.slice("_t", F.lit(2), F.greatest(F.size("_t") - 1, F.lit(0))))
    # Rows and not lambdas: so the hashes are compiled code. An inner explode would infer a filter that cuts every text twice.
    each = cut_up.select(*names, F.explode_outer(F.arrays_zip("_t", "_u")).alias("_z")).select(*names, F.col("_z._t").alias("_t"), F.col("_z._u").alias("_u"))
    both = F.array(F.when(F.col("_t").isNotNull(), cell("_t")), F.when(F.col("_u").isNotNull(), cell("_t", "_u")))
    return each.select(*names, F.explode_outer(both).alias("cell"))


def marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(text, target): 1 for a target document, else 0. Texts stay where they are unless the ids outgrow a broadcast, as in ``by_ids``."""
    ids = materialise(trusted.select("doc_id").distinct(), "ids").withColumn("target", F.lit(1))
    joined = docs.select("doc_id", "text").join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left")
    return joined.select("text", F.coalesce("target", F.lit(0)).alias("target"))


def ngram_rows(docs: DataFrame, trusted: DataFrame, buckets: int | None) -> DataFrame:
    """(target, cell) of every n-gram of every document."""
    return cell_rows(marked(docs, trusted), buckets, "target").filter("cell IS NOT NULL")


def tally(docs: DataFrame, trusted: DataFrame, buckets: int | None = None) -> DataFrame:
    """(cell, raw, target): how often each n-gram occurs in all documents and in those that ``trusted(doc_id)`` names."""
    if buckets is None:
        counted = ngram_rows(docs, trusted, None).groupBy("cell").agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
        return materialise(counted, "ngrams")
    listed = listed_cells(ngram_rows(docs, trusted, buckets), frequent_cells(docs, buckets))
    with setting(docs.sparkSession, *LISTS_IN_MEMORY):
        return materialise(tally_of_lists(listed), "ngrams")


def frequent_cells(docs: DataFrame, buckets: int) -> DataFrame:
    """(cell) of those that alone have a ``SHARE`` th of what ``SPAN`` cells have on average, by a sample. Changes no result."""
    sample = cell_rows(docs.sample(SAMPLE, 1), buckets).filter("cell IS NOT NULL")
    counted = materialise(sample.groupBy("cell").count(), "sample")
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    least = max(1, total * SPAN // (SHARE * buckets), total // BROADCAST_IDS)  # so at most that many are broadcast
    return materialise(counted.filter(F.col("count") > least).select("cell"), "frequent")


def listed_cells(each: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, raw, target, places): a key for ``SPAN`` neighbouring cells with the place of each n-gram, those of the target less ``SPAN``.

    A place is two bytes, so a list moves less than a row of counts for each cell that a task met. A frequent cell
    has a negative key of its own and counts instead of a list, so no list is long by one cell.
    """
    marked_cells = each.join(F.broadcast(frequent.withColumn("alone", F.lit(True))), "cell", "left")
    key = F.when(F.col("alone"), -1 - F.col("cell")).otherwise(F.floor(F.col("cell") / SPAN))
    place = F.when(F.col("alone").isNull(), F.pmod("cell", F.lit(SPAN)) - F.col("target") * SPAN).cast("smallint")
    keyed = marked_cells.select(key.alias("key"), F.when(F.col("alone"), F.col("target")).alias("target"), place.alias("place"))
    return keyed.groupBy("key").agg(F.count("*").alias("raw"), F.sum("target").alias("target"), F.collect_list("place").alias("places"))


def tally_of_lists(listed: DataFrame) -> DataFrame:
    """(cell, raw, target) from ``listed_cells``, without another shuffle: a cell is where its list is."""
    each = listed.select("key", "raw", "target", F.explode_outer("places").alias("place"))
    one = F.col("key") >= 0
    cell = F.when(one, F.col("key") * SPAN + F.pmod("place", F.lit(SPAN))).otherwise(-1 - F.col("key"))
    raw, target = F.when(one, 1).otherwise(F.col("raw")), F.when(one, (F.col("place") < 0).cast("int")).otherwise(F.col("target"))
    rows = each.select("key", cell.alias("cell"), raw.alias("raw"), target.alias("target"))
    return rows.groupBy("key", "cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).drop("key")


def weigh(counted: DataFrame, buckets: int | None = None) -> DataFrame:
    """(cell, raw, weight) from ``tally``: the log-likelihood ratio in units of 1 / ``UNIT``, target against raw corpus."""
    total = counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    smooth = buckets or total["n"]
    share = lambda name: F.log((F.col(name) + 1) / F.lit(float(total[name] + smooth)))
    return counted.select("cell", "raw", F.rint(UNIT * (share("target") - share("raw"))).cast("int").alias("weight"))


def weights(docs: DataFrame, trusted: DataFrame, buckets: int | None = None) -> DataFrame:
    """(cell, raw, weight) of each n-gram that occurs. Without ``buckets`` every n-gram has a row of its own."""
    return weigh(tally(docs, trusted, buckets), buckets)


def score(docs: DataFrame, table: DataFrame, buckets: int | None = None) -> DataFrame:
    """(key, llr): the mean weight of the n-grams of each text that has any, by ``text_key``; sums are of integers, so exact.

    Copies of a text add to its sum and its count alike. The most frequent n-gram of each of ``SLOTS`` slots is looked
    up where the text is; all other n-grams are joined to their weights, so neither part is hot and none is left out.
    """
    slot = lambda c: F.pmod(c, F.lit(SLOTS)).cast("int")
    top = table.groupBy(slot(F.col("cell")).alias("slot")).agg(F.max(F.struct("raw", "cell", "weight")).alias("top")).select("slot", "top.cell", "top.weight")
    near = {row["slot"]: row for row in top.collect()}
    listed = lambda name, kind: F.split(F.lit(",".join(str(near[i][name]) if i in near else "0" for i in range(SLOTS))), ",").cast(f"array<{kind}>")
    names, values = listed("cell", "bigint"), listed("weight", "int")
    is_near = lambda c: F.get(names, slot(c)) == c
    found = found_cells(docs.select(text_key().alias("key"), "text"), buckets).drop("text")
    split = found.select(
        "key", F.size("_cells").alias("n"),
        F.aggregate("_cells", F.lit(0).cast("long"), lambda a, c: a + F.when(is_near(c), F.get(values, slot(c))).otherwise(0)).alias("sum"),
        F.filter("_cells", lambda c: ~is_near(c)).alias("_far"),
    )
    # The first row of a text carries what is settled already.
    rest = split.select("key", "n", "sum", F.posexplode_outer("_far").alias("i", "cell"))
    first = F.coalesce("i", F.lit(0)) == 0
    rest = rest.select("key", "cell", F.when(first, F.col("n")).otherwise(0).alias("n"), F.when(first, F.col("sum")).otherwise(0).alias("sum"))
    # Texts without such an n-gram are dealt by their own key.
    at = rest.withColumn("at", F.coalesce("cell", "key"))
    joined = at.join(table.select(F.col("cell").alias("at"), "weight"), "at", "left")
    weight = F.when(F.col("cell").isNotNull(), F.col("weight")).otherwise(0)
    total = joined.groupBy("key").agg(F.sum(F.col("sum") + weight).alias("sum"), F.sum("n").alias("n")).filter("n > 0")
    return total.select("key", (F.col("sum") / (F.col("n") * float(UNIT))).alias("llr"))


def weight_lists(table: DataFrame) -> DataFrame:
    """(piece, weights): the weights of ``LIST`` neighbouring cells in order, up to the last that occurs; 0 for one that does not."""
    piece, at = F.floor(F.col("cell") / LIST), F.pmod("cell", F.lit(LIST)).cast("int")
    listed = table.groupBy(piece.alias("piece")).agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("weight").cast("smallint").alias("weight")))).alias("_found"))
    gap = lambda x, i: x["at"] - F.coalesce(F.get("_found", i - 1)["at"], F.lit(-1)) - 1
    none = F.lit(0).cast("smallint")
    dense = F.transform("_found", lambda x, i: F.concat(F.array_repeat(none, gap(x, i)), F.array(x["weight"])))
    return listed.select("piece", F.flatten(dense).alias("weights"))


def looked_up(docs: DataFrame, lists: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, the counts, base_failed, llr): the weights are looked up where the text is; a row a document moves, which has its counts."""
    # Rows are told apart by a number of their own, as ids and texts may repeat.
    counted = counts(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row")))
    kept = [name for name in counted.columns if name != "text"]
    joined = cell_rows(counted, buckets, *kept).withColumn("piece", F.floor(F.col("cell") / LIST)).join(F.broadcast(lists), "piece", "left")
    weight = F.get("weights", F.pmod("cell", F.lit(LIST)).cast("int"))
    total = joined.groupBy(*kept).agg(F.sum(weight).alias("sum"), F.count("cell").alias("n"))
    llr = F.when(F.col("n") > 0, F.col("sum") / (F.col("n") * float(UNIT))).otherwise(0.0)
    return total.select(*(name for name in kept if name != "_row"), llr.alias("llr"))


def text_key() -> Column:
    return F.xxhash64(F.col("text"))


def cell_count(docs: DataFrame) -> int:
    """One cell for every ``CHARS_A_CELL`` characters of all texts, ``LEAST_CELLS`` at least."""
    chars = docs.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    return max(LEAST_CELLS, chars // CHARS_A_CELL)


# --- n-grams by cell, in numpy over Arrow batches ---

def ngram_cells(text: str, buckets: int) -> Iterator[np.ndarray]:
    """The cells of all n-grams of a text, as ``cells`` gives them, for a block of tokens at a time."""
    found, digest, last = _TOKEN.finditer(text), xxhash.xxh64_intdigest, []
    while tokens := [m[0].encode("utf-8", "surrogatepass") for m in islice(found, BLOCK)]:
        single = [digest(t, 42) for t in tokens]
        # The hash of a pair is that of its second token, seeded with the hash of the first.
        pairs = [digest(t, seed) for t, seed in zip(tokens if last else tokens[1:], chain(last, single), strict=False)]
        last = single[-1:]
        yield np.fromiter(chain(single, pairs), np.uint64, len(single) + len(pairs)).view(np.int64) % buckets


def piece_width(buckets: int) -> int:
    return min(PIECE[1], max(PIECE[0], buckets >> 12))


def planes(values: np.ndarray, width: int) -> bytes:
    """Whole numbers of ``width`` bytes, all lowest bytes first: small numbers leave runs of zeros."""
    return values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


#: Bytes of the three columns of a piece: step to the next cell that occurs, its n-grams, and those of the target.
STEPS, RAW, TARGET = 4, 4, 4


def packed_pieces(keys: np.ndarray, width: int) -> Iterator[tuple[int, bytes]]:
    """(piece, counts) from keys, each twice a cell plus 1 for the target."""
    keys.sort()
    cell = keys >> 1
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    raw, target = np.diff(first, append=len(cell)), np.add.reduceat(keys & 1, first)
    cell = cell[first]
    piece = cell // width
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    for start, end in zip(starts, chain(starts[1:], [len(cell)]), strict=True):
        steps = np.diff(cell[start:end] % width, prepend=0)
        yield int(piece[start]), zlib.compress(planes(steps, STEPS) + planes(raw[start:end], RAW) + planes(target[start:end], TARGET), 1)


def add_piece(sums: np.ndarray, counts: bytes) -> None:
    """Add the counts of one piece to the sums, (2, width): all n-grams, and those of the target."""
    data = zlib.decompress(counts)
    n = len(data) // (STEPS + RAW + TARGET)
    at = np.cumsum(from_planes(data[: n * STEPS], STEPS))
    sums[0, at] += from_planes(data[n * STEPS : n * (STEPS + RAW)], RAW)
    sums[1, at] += from_planes(data[n * (STEPS + RAW) :], TARGET)


def cell_sums(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """(piece, raw, target, sums): the n-grams of each piece of cells, and by cell as two rows of 64-bit numbers."""
    width = piece_width(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            pieces = packed_pieces(np.concatenate(held), width)
            while some := list(islice(pieces, 256)):
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.int64()), pa.array([c for _, c in some], pa.binary())], ["piece", "counts"])

        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for found in ngram_cells(text.as_py() or "", buckets):
                    held.append(found * 2 + target)
                    size += len(found)
                    if size >= HELD:
                        yield from flush()
                        held, size = [], 0
        if held:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def row() -> pa.RecordBatch:
            raw, target = (int(x) for x in sums.sum(axis=1))
            return pa.RecordBatch.from_pydict({"piece": [now], "raw": [raw], "target": [target], "sums": [sums.tobytes()]})

        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if piece != now:
                    if now is not None:
                        yield row()
                    now, sums = piece, np.zeros((2, width), np.int64)
                add_piece(sums, counts.as_py())
        if now is not None:
            yield row()

    counted = map_batches(marked(docs, trusted), count, "piece bigint, counts binary")
    ordered = counted.repartition("piece").sortWithinPartitions("piece")
    return materialise(map_batches(ordered, add, "piece bigint, raw bigint, target bigint, sums binary"), "cells")


def cell_weights(sums: DataFrame, buckets: int) -> DataFrame:
    """(piece, raw, weights): the n-grams and the weight of each cell of a piece, in order, as 64-bit and 16-bit numbers."""
    total = sums.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    of_raw, of_target = float(total["raw"] + buckets), float(total["target"] + buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw, target = np.frombuffer(data.as_py(), np.int64).reshape(2, -1)
                # A ratio of shares is below e ** 32, so 16 bits are enough for thousandths of its logarithm.
                weight = np.rint(UNIT * (np.log((target + 1) / of_target) - np.log((raw + 1) / of_raw))).astype(np.int16)
                yield pa.RecordBatch.from_pydict({"piece": [piece], "raw": [raw.tobytes()], "weights": [weight.tobytes()]})

    return map_batches(sums.select("piece", "sums"), run, "piece bigint, raw binary, weights binary")


def weight_array(weighed: DataFrame, buckets: int) -> np.ndarray:
    """The weights of all cells in order, at most ``ARRAY_CELLS``; 0 in a piece without n-grams."""
    width = piece_width(buckets)
    out = np.zeros(-(-buckets // width) * width, np.int16)
    for row in weighed.select("piece", "weights").toLocalIterator():
        out[row["piece"] * width : (row["piece"] + 1) * width] = np.frombuffer(row["weights"], np.int16)
    return out[:buckets]


def weight_rows(weighed: DataFrame, buckets: int) -> DataFrame:
    """(cell, raw, weight) of each cell that occurs."""
    width = piece_width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, raw, weight in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                raw, weight = np.frombuffer(raw, np.int64), np.frombuffer(weight, np.int16)
                at = np.flatnonzero(raw)
                yield pa.RecordBatch.from_arrays([pa.array(at + piece * width), pa.array(raw[at]), pa.array(weight[at].astype(np.int32))], ["cell", "raw", "weight"])

    return map_batches(weighed, run, "cell bigint, raw bigint, weight int")


def scores_in_place(docs: DataFrame, array: np.ndarray) -> DataFrame:
    """(doc_id, the counts, base_failed, llr) with the weights looked up where the text is: nothing is shuffled."""
    counted = counts(docs.select("doc_id", "text"))
    kept = [field for field in counted.schema.fields if field.name != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(array)

    def ratio(text: str) -> float:
        total = n = 0
        for found in ngram_cells(text, len(shared.value)):
            total += int(shared.value[found].sum(dtype=np.int64))
            n += len(found)
        return total / (n * float(UNIT)) if n else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratios = pa.array([ratio(text.as_py() or "") for text in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), ratios], [*(f.name for f in kept), "llr"])

    return map_batches(counted, run, T.StructType([*kept, T.StructField("llr", T.DoubleType())]))


def scores(docs: DataFrame, trusted: DataFrame, buckets: int | None = None, arrow: bool = False) -> DataFrame:
    """(doc_id, the counts, base_failed, llr) for every document; texts without n-grams have 0. ``arrow`` is for cells only."""
    rows = docs.select("doc_id", "text")
    if buckets and arrow:
        weighed = cell_weights(cell_sums(rows, trusted, buckets), buckets)
        if buckets <= ARRAY_CELLS:
            return scores_in_place(rows, weight_array(weighed, buckets))
        table = materialise(weight_rows(weighed, buckets), "weights")
    else:
        table = weights(rows, trusted, buckets)
        if buckets and buckets <= ARRAY_CELLS:
            return looked_up(rows, materialise(weight_lists(table), "weights"), buckets)
    found = score(rows, table, buckets)
    counted = counts(rows).withColumn("key", text_key()).drop("text")
    return counted.join(found, "key", "left").drop("key").withColumn("llr", F.coalesce("llr", F.lit(0.0)))


def cut(scored: DataFrame) -> float:
    """``SPREADS`` spreads below the median ratio of the documents that pass the base rules.

    The ratios are counted in whole units of 1 / ``UNIT``, so the driver gets as many rows as the range of a ratio has.
    """
    unit = F.rint(F.col("llr") * UNIT).cast("int").alias("unit")
    found = [tuple(row) for row in scored.filter("NOT base_failed").groupBy(unit).count().collect()]

    def median(rows: list[tuple[int, int]]) -> int:
        left = sum(n for _, n in rows) // 2
        for value, n in sorted(rows):
            if left < n:
                return value
            left -= n
        return 0

    middle = median(found)
    spread = max(LEAST_SPREAD, median([(abs(value - middle), n) for value, n in found]))
    return (middle - SPREADS * spread) / UNIT


def judge(docs: DataFrame, trusted: DataFrame, buckets: int | None = None, threshold: float | None = None, arrow: bool = False) -> DataFrame:
    """(doc_id, the counts, base_failed, llr, kept) for every document; ``buckets`` as ``cell_count`` gives them, or None."""
    scored = scores(docs, trusted, buckets, arrow)
    if threshold is None:
        scored = materialise(scored, "llr")
        threshold = cut(scored)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
