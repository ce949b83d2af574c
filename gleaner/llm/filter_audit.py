"""Filter interaction audit: what each filter removes on its own, after others, and in every order.

Five filters judge whole texts. Four of them (A to D) look at one text; E fails a document whose text equals that of a
document with a smaller id anywhere in the table. E is an existential self-join: a left-semi join on the hash, the
exact text and a smaller ``doc_id``. Its ids are united with the ids of the other failures, each id gets one number
whose bits are the filters it fails, and the combinations of bits are counted by part. All orders are then worked out
from those counts, at most 32 rows a part, so no order needs another look at the texts.

Only documents whose hash occurs more than once take part in the join. The other side of it has one row for each
distinct text, with its smallest id, so a group of copies is never joined with itself. Groups with many copies are
dealt over several tasks by a salt; at most ``HOT_GROUPS`` groups are salted, so the list of them is broadcast.

Defined results: a null text is empty, an empty text has no words and fails A only (and E as any other copy); a null
``lang`` is the part ``''``; a null ``doc_id`` is smaller than none and larger than none, so it never fails E; repeated
rows count once each, and equal ids are no copies of each other; a document is good or toxic if any of its labels says
so; an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import BROADCAST_IDS, words
from gleaner.session import materialise

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
SYMBOLS = "[#$%&*|]"
#: Copies of one text that a task of the self-join gets at most (more only beyond ``HOT_GROUPS`` such groups).
COPIES = 1000
#: Salted groups at most; their list is broadcast (about 50 bytes each).
HOT_GROUPS = 100_000


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def text_failures(text: Column) -> Column:
    """The bits of the filters A to D that a text (not null) fails."""
    found = words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    # The words are made once: a one-element array binds them.
    counted = F.transform(F.array(found), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    of_words = F.transform(F.array(counted), lambda c: (
        F.when(c["n"] < MIN_WORDS, bit("A")).otherwise(0)
        + F.when(100 * c["d"].cast("long") < MIN_DISTINCT * c["n"].cast("long"), bit("B")).otherwise(0)
    ))[0]
    return (
        of_words
        + F.when(100 * capitals.cast("long") > MAX_CAPITALS * F.length(text).cast("long"), bit("C")).otherwise(0)
        + F.when(text.rlike(SYMBOLS), bit("D")).otherwise(0)
    )


def _hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text, h): whole texts with their hash."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    return rows.withColumn("h", F.unhex(F.sha2("text", 256)))


def copies(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, part, h) of the documents whose text is that of a smaller id; ``ids`` holds (doc_id, h) of all documents."""
    groups = materialise(ids.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "copies")
    counted = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    # At most HOT_GROUPS groups can hold more than this many of the rows.
    many = max(COPIES, counted["rows"] // HOT_GROUPS)
    hot = F.broadcast(groups.filter(F.col("n") > many).select("h", F.ceil(F.col("n") / COPIES).cast("int").alias("salts")))
    salted = lambda rows: rows.join(hot, "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    rows = salted(_hashed(docs)).withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts").cast("int"))
    spread = lambda rows: rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    if counted["groups"] <= BROADCAST_IDS:
        shared = rows.join(F.broadcast(groups.select("h")), "h", "left_semi")
    else:
        shared = rows.join(spread(salted(groups.select("h"))), ["h", "salt"], "left_semi")
    # Copies meet in the map-side part of this aggregate; what is shuffled are distinct texts of each task.
    first = spread(salted(shared.groupBy("h", "text").agg(F.min("doc_id").alias("first")))).alias("f")
    later = shared.alias("d")
    same = (F.col("d.h") == F.col("f.h")) & (F.col("d.salt") == F.col("f.salt")) & (F.col("d.text") == F.col("f.text"))
    return later.join(first, same & (F.col("f.first") < F.col("d.doc_id")), "left_semi").select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents, good ones and toxic ones by the set of filters they fail.

    ``docs(doc_id, text, lang)``; ``labels(doc_id, quality, toxic)``.
    """
    others = _hashed(docs).select("doc_id", "part", "h", text_failures(F.col("text")).alias("bits"))
    others = materialise(others, "failures")
    repeated = copies(docs, others.select("doc_id", "h")).select(
        "doc_id", "part", "h", F.lit(bit("E")).alias("bits"), F.lit(0).cast("long").alias("n")
    )
    united = others.withColumn("n", F.lit(1).cast("long")).unionByName(repeated)
    # A row of the table is known by its id, part and text: repeated rows fail the same filters.
    each = united.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    by_id = each.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    marked = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("long")).alias(name)
    known = labels.groupBy("doc_id").agg(marked("quality"), marked("toxic")).filter("quality = 1 OR toxic = 1")
    joined = by_id.join(known, "doc_id", "left")
    of = lambda name: F.sum(F.col("n") * F.coalesce(name, F.lit(0)))
    return joined.groupBy("part", "bits").agg(F.sum("n").alias("n"), of("quality").alias("good"), of("toxic").alias("toxic"))


def steps() -> Column:
    """All orders of the filters, step by step: (filter_order, step, own bit, bits of the earlier steps)."""
    rows = []
    for order in permutations(FILTERS):
        for i, name in enumerate(order):
            rows.append(F.struct(
                F.lit("".join(order)).alias("filter_order"), F.lit(i + 1).alias("step"),
                F.lit(bit(name)).alias("own"), F.lit(sum(map(bit, order[:i]))).alias("before"),
            ))
    return F.array(*rows)


def audit(counted: DataFrame) -> DataFrame:
    """One row per part, order and step from the combinations of ``combinations``.

    ``shapley`` is what a filter removes, summed over all orders: of a document that fails s filters each of them removes
    it in one of s orders.
    """
    each = counted.withColumn("_s", F.explode(steps())).select("*", "_s.*").drop("_s")
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0
    gone = F.col("bits").bitwiseAND(F.col("before")) != 0
    here = fails & ~gone
    orders = len(list(permutations(FILTERS)))
    share = F.floor(F.lit(orders) / F.greatest(F.bit_count("bits"), F.lit(1)))
    total = lambda name, when: F.sum(F.when(when, F.col(name)).otherwise(0)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", here).alias("removed"), total("n", fails & gone).alias("redundant"),
        total("n", F.col("bits") == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share).otherwise(0)).cast("long").alias("shapley"),
    )
