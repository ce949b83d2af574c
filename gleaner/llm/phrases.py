"""Phrase collocations by sampling and an exact pass over everything (Toivonen's method).

Phrases are runs of two to four words inside one piece of a text, counted for each language. A sample of the documents
proposes phrases that may be frequent. One pass over all texts then counts these together with their negative border: the
phrases that are not proposed themselves, but whose first and last part (all but one word) both are. What turns out
frequent outside the proposal is a border failure: longer phrases through it have not been counted yet. Each such failure
joins the proposal and another pass counts what it adds, until no failure is left. As every part of a frequent phrase is
frequent, no phrase can be missed, whatever the sample was; it only decides how much a pass counts.

Most of the border is rare, so these passes count 64-bit hashes of phrases. Phrases that share a hash share a count, which
is never too low; a last pass counts the words themselves of all phrases whose hash was frequent, so counts are exact.

The proposal travels as a bit map of hashes whose size follows the number of proposals up to ``MAX_BITS``. A collision
lets a phrase be counted that need not be. Texts are read where they are; each task sends a phrase once per chunk of text.

The score of a phrase is that of its weakest cut: ``floor(SCALE * a / (l + r))`` for the counts of the phrase, of its
first words and of the rest.

Defined results: null and empty texts have no words; a null ``lang`` is ``und``; repeated rows count again; an empty table
gives no row; ``doc_id`` only draws the sample, so it may be null; other columns are ignored, whatever their names. Text of
any length is cut at piece borders into chunks; a piece is never cut.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import map_batches
from gleaner.session import materialise

MIN_COUNT = 30
LONGEST = 4
#: Share of the documents that propose phrases: one in this many.
SAMPLE = 8
#: Occurrences in the sample from which on a phrase is proposed (a lowered bound: 30 / 8 would be 3.75).
SAMPLE_COUNT = 2
#: Bits per hash in a map, and the least and greatest size of the map (32 MB).
BITS, MIN_BITS, MAX_BITS = 32, 1 << 20, 1 << 28
#: Bytes of text of a language that are counted at once in a task, and bytes of all languages that wait for that.
CHUNK, HELD = 5 << 20, 20 << 20
SCALE = 2_000_000
#: A phrase inside a longer one with this share (per cent) of its occurrences is dropped.
COVERED = 80
UNKNOWN = "und"
#: Parts that hold more than one in this many of the looked-up rows are broadcast: there are fewer than this many.
HEAVY = 256
#: Bits of a block of the map, and rows that a task sends at once.
BLOCK = 1 << 19
ROWS = 100_000

#: What a text is cut at, and how its bytes are folded: capitals to small letters, cuts to a line feed, tabs to spaces.
_CUTS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if c in _CUTS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
# The mixing constants of splitmix64.
_MIX, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its first words and of its last word."""
    h = left * _MIX + right
    h ^= h >> np.uint64(29)
    h *= _STIR
    return h ^ (h >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), 1))


def _inside(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether hashed phrases are in a map of 2^n bits."""
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class _Chunks:
    """Folded texts of each language, joined by cuts, in chunks of about ``CHUNK`` bytes that end at a cut.

    Texts are held across batches, ``HELD`` bytes at most, so that a phrase of a rarer language is not sent once per batch.
    """

    def __init__(self) -> None:
        self.held: defaultdict[str, list[bytes]] = defaultdict(list)
        self.size: defaultdict[str, int] = defaultdict(int)

    def add(self, lang: str, text: bytes) -> Iterator[tuple[str, bytes]]:
        folded = text.translate(_FOLD)
        while len(folded) > CHUNK and (cut := folded.find(b"\n", CHUNK)) >= 0:
            yield lang, folded[:cut]
            folded = folded[cut + 1 :]
        self.held[lang].append(folded)
        self.size[lang] += len(folded)
        if self.size[lang] >= CHUNK:
            yield self.take(lang)
        if sum(self.size.values()) >= HELD:
            yield from self.rest()

    def take(self, lang: str) -> tuple[str, bytes]:
        del self.size[lang]
        return lang, b"\n".join(self.held.pop(lang))

    def rest(self) -> Iterator[tuple[str, bytes]]:
        for lang in list(self.held):
            yield self.take(lang)


def _tokens(chunk: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of a chunk, and for each word in turn its number and that of its piece."""
    data = np.frombuffer(chunk, np.uint8)
    cuts = data == 10
    space = cuts | (data == 32)
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    # The words without the space between them, as one array that is numbered as a whole.
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[~space])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.cumsum(cuts, dtype=np.int32)[starts]


def _hashed(words: pa.Array, ids: np.ndarray, piece: np.ndarray, seed: np.uint64, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hashes, inside) for phrases of k words from each word on; ``inside`` marks those of one piece."""
    each = _word_hashes(words.to_pylist())[ids]
    hashes = _join(np.full(len(ids), seed, np.uint64), each)
    for k in range(1, min(longest, len(ids)) + 1):
        yield k, hashes, piece[k - 1 :] == piece[: len(piece) - k + 1]
        hashes = _join(hashes[:-1], each[k:])


def _tally(
    chunk: bytes, seed: np.uint64, wanted: np.ndarray | None, counted: np.ndarray | None, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hashes, counts) of a chunk.

    With ``wanted`` a longer phrase is taken if both its parts are in this map and its first part was taken. With
    ``counted`` those that this older map took are left out, and so are words.
    """
    taken = done = wanted_parts = counted_parts = None
    for k, hashes, inside in _hashed(*_tokens(chunk), seed, longest):
        if k == 1:
            taken = done = inside
        else:
            taken = taken[:-1] & inside & (wanted is None or wanted_parts[:-1] & wanted_parts[1:])
            done = done[:-1] & inside & (counted is not None and counted_parts[:-1] & counted_parts[1:])
        fresh = taken if counted is None else taken & ~done
        found, n = np.unique(hashes[fresh], return_counts=True)
        yield k, found, n
        if wanted is not None and k < longest:
            wanted_parts = _inside(wanted, hashes)
        if counted is not None and k < longest:
            counted_parts = _inside(counted, hashes)


def _spelled(chunk: bytes, seed: np.uint64, wanted: np.ndarray) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(k, phrases, counts) of the phrases of a chunk that are in the map; all its words together come as k = 0."""
    words, ids, piece = _tokens(chunk)
    names = words.cast(pa.string())
    yield 0, pa.array([""]), np.array([len(ids)])
    taken = None
    for k, hashes, inside in _hashed(words, ids, piece, seed, LONGEST):
        # A part of a frequent phrase is frequent, so it is in the map as well.
        taken = inside & _inside(wanted, hashes) & (True if taken is None else taken[:-1])
        at = np.flatnonzero(taken)
        table, codes, n = names, *np.unique(ids[at], return_counts=True)
        if k == 1:
            yield k, names.take(pa.array(codes)), n
            continue
        codes = ids[at]
        for i in range(1, k):
            # A phrase is the code of its first words and its last word.
            pairs, codes, n = np.unique(codes * len(words) + ids[at + i], return_inverse=True, return_counts=True)
            table = pc.binary_join_element_wise(table.take(pa.array(pairs // len(words))), names.take(pa.array(pairs % len(words))), " ")
        yield k, table, n


def _over_chunks(docs: DataFrame, run, schema: str) -> DataFrame:
    """``run(chunk, lang)`` over the chunks of ``docs(lang, text)``; it yields record batches."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks()
        for batch in rows:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for own, chunk in chunks.add(lang, text):
                    yield from run(chunk, own)
        for own, chunk in chunks.rest():
            yield from run(chunk, own)

    return map_batches(docs.select("lang", "text"), batches, schema)


def count_hashes(docs: DataFrame, wanted: Broadcast | None = None, counted: Broadcast | None = None, longest: int = LONGEST) -> DataFrame:
    """(k, h, n): counts of hashed phrases of ``docs(lang, text)``; see ``_tally``."""

    def run(chunk: bytes, lang: str) -> Iterator[pa.RecordBatch]:
        maps = (wanted.value if wanted else None, counted.value if counted else None)
        for k, found, n in _tally(chunk, _seed(lang), *maps, longest):
            for i in range(0, len(found), ROWS):
                some = found[i : i + ROWS].view(np.int64)
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(some), k, np.int32)), "h": pa.array(some), "n": pa.array(n[i : i + ROWS], pa.int64())})

    return _over_chunks(docs, run, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n"))


def spell(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """(lang, k, phrase, n): exact counts of the phrases of ``docs(lang, text)`` that are in the map; k = 0 counts all words."""

    def run(chunk: bytes, lang: str) -> Iterator[pa.RecordBatch]:
        for k, phrases, n in _spelled(chunk, _seed(lang), wanted.value):
            for i in range(0, len(phrases), ROWS):
                some = phrases.slice(i, ROWS)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.repeat(pa.scalar(lang, pa.string()), len(some)), "k": pa.repeat(pa.scalar(k, pa.int32()), len(some)),
                    "phrase": some, "n": pa.array(n[i : i + ROWS], pa.int64()),
                })

    return _over_chunks(docs, run, "lang string, k int, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def map_size(hashes: int) -> int:
    """Bits of a map of that many hashes."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS * hashes).bit_length()))


def bit_map(hashes: DataFrame, size: int) -> np.ndarray:
    """The map of ``size`` bits (a power of two) of ``hashes(h)``.

    Each block of the map is put together in a task of its own; the driver gets the map, at most ``MAX_BITS``.
    """

    def set_bits(table: pa.Table) -> pa.Table:
        block = np.zeros(BLOCK, np.uint8)
        block[table.column("place").to_numpy()] = 1
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "bits": [np.packbits(block, bitorder="little").tobytes()]})

    at = F.col("h").bitwiseAND(F.lit(size - 1))
    placed = hashes.select(F.floor(at / BLOCK).cast("int").alias("block"), (at % BLOCK).cast("int").alias("place")).distinct()
    out = np.zeros(size // 8, np.uint8)
    for row in placed.groupBy("block").applyInArrow(set_bits, "block int, bits binary").toLocalIterator():
        first = row["block"] * BLOCK // 8
        out[first : first + BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def outside(hashes: DataFrame, known: Broadcast) -> DataFrame:
    """The rows of ``hashes(h)`` that are not in the map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~_inside(known.value, batch.column("h").to_numpy().view(np.uint64))))

    return map_batches(hashes.select("h"), run, "h long")


def frequent(docs: DataFrame, least: int = MIN_COUNT, sample: int = SAMPLE, sample_count: int = SAMPLE_COUNT) -> DataFrame:
    """(lang, k, phrase, n) of all phrases of one to ``LONGEST`` words that occur ``least`` times or more.

    Rows with k = 0 hold the number of words of each language. One document in ``sample`` proposes phrases.
    """
    ship = docs.sparkSession.sparkContext.broadcast
    rows = docs.select("doc_id", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    sampled = count_hashes(rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0), longest=LONGEST - 1)
    proposed = materialise(sampled.filter(F.col("n") >= sample_count).select("h"), "proposed")
    bits = bit_map(proposed, map_size(proposed.count()))
    counted, wanted = None, ship(bits)
    found = None
    while True:
        tally = materialise(count_hashes(rows, wanted, counted).filter(F.col("n") >= least), "hashes")
        found = tally if found is None else found.unionByName(tally)
        failures = materialise(outside(tally.filter(F.col("k") < LONGEST), wanted), "failures")
        if failures.isEmpty():
            break
        bits = bits | bit_map(failures, len(bits) * 8)
        counted, wanted = wanted, ship(bits)
    last = ship(bit_map(found, map_size(found.count())))
    return materialise(spell(rows, last).filter((F.col("k") == 0) | (F.col("n") >= least)), "phrases")


def _counts_of(parts: DataFrame, found: DataFrame) -> DataFrame:
    """``parts(lang, part, ...)`` with the count ``f`` of each part.

    Parts that many phrases share are fewer than ``HEAVY`` and are looked up in a broadcast list; no other part holds
    more than that share of the rows that are joined by key.
    """
    stored = materialise(parts, "parts")
    known = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    total = stored.count()
    heavy = stored.groupBy("lang", "part").count().filter(F.col("count") > max(1000, total // HEAVY)).select("lang", "part")
    heavy = materialise(known.join(F.broadcast(heavy), ["lang", "part"], "left_semi"), "heavy")
    near = stored.join(F.broadcast(heavy), ["lang", "part"], "left")
    far = near.filter("f IS NULL").drop("f").join(known, ["lang", "part"])
    return near.filter("f IS NOT NULL").unionByName(far)


def _words(first: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice("w", first, length), " ")


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more that no longer one covers."""
    phrases = found.filter("k >= 2").withColumn("w", F.split("phrase", " ")).withColumnRenamed("n", "a")
    part = lambda cut, side, text: F.struct(F.lit(cut).alias("cut"), F.lit(side).alias("side"), text.alias("part"))
    cuts = F.array(*(
        F.when(F.col("k") > cut, part(cut, *side)) for cut in range(1, LONGEST)
        for side in (("l", _words(1, cut)), ("r", _words(cut + 1, LONGEST)))
    ))
    parts = phrases.select("lang", "phrase", "a", F.explode(F.filter(cuts, lambda x: x.isNotNull())).alias("p")).select("lang", "phrase", "a", "p.*")
    known = _counts_of(parts, found.filter(F.col("k").between(1, LONGEST - 1)))
    side = lambda cut, name: F.max(F.when((F.col("cut") == cut) & (F.col("side") == name), F.col("f"))).alias(f"{name}{cut}")
    each = known.groupBy("lang", "phrase", "a").agg(*(side(cut, name) for cut in range(1, LONGEST) for name in "lr"))
    score = lambda cut: F.expr(
        f"CAST({SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) div (CAST(l{cut} AS DECIMAL(19, 0)) + CAST(r{cut} AS DECIMAL(19, 0)))"
    )
    weakest = F.array_min(F.array(*(
        F.when(F.col(f"l{cut}").isNotNull(), F.struct(
            score(cut).alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")
        )) for cut in range(1, LONGEST)
    )))
    # A longer phrase with enough occurrences has a part one word longer than this one with at least as many.
    longer = found.filter("k >= 3").withColumn("w", F.split("phrase", " "))
    inner = longer.select("lang", "n", F.explode(F.array(_words(1, F.col("k") - 1), _words(2, F.col("k") - 1))).alias("phrase"))
    cover = inner.groupBy("lang", "phrase").agg(F.max("n").alias("cover"))
    kept = each.join(cover, ["lang", "phrase"], "left").filter(F.col("cover").isNull() | (100 * F.col("cover") < COVERED * F.col("a")))
    totals = found.filter("k = 0").select("lang", "n")
    return kept.withColumn("_s", weakest).join(totals, "lang").select("lang", "phrase", "a", "_s.l", "_s.r", "n", "_s.score")


def collocations(docs: DataFrame, top: int, **options: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Each language is ranked in parts first, of whose best the last task takes the best; parts are about as large as what
    they leave for it.
    """
    rows = materialise(scored(frequent(docs, **options)), "scored")
    parts = 1 + int((rows.count() / top) ** 0.5)
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    best = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = best.withColumn("rank", rank("lang", "_part")).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", rank("lang")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
