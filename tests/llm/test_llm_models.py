import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gleaner.llm import bpe, classifier

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sample(rng, good):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 90))]
    return " ".join(w + ("" if good else "%%%") if rng.random() < 0.9 else w + "." for w in words)


def test_trees_learn_and_equal_a_walk():
    rng = np.random.default_rng(3)
    table = rng.standard_normal((3000, len(classifier.FEATURES))).astype(np.float32)
    labels = ((table[:, 0] > 0.3) ^ (table[:, 5] > 0)).astype(float)
    forest = classifier.fit(table[:2000], labels[:2000])
    score = forest.score(table[2000:])
    assert ((score >= 0.5) == labels[2000:]).mean() > 0.95
    binned = forest.binned(table[2000:2020])
    for row, want in zip(binned, score, strict=False):
        total = forest.base
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert abs(1 / (1 + np.exp(-total)) - want) < 1e-9


def test_classifier_on_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, sample(rng, i % 3 > 0), 0.1, "l") for i in range(600)] + [(600, None, 0.2, "l"), (601, "", 0.2, "l"), (1, None, 0.2, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(5, None), (6, 7), (None, 1), (9999, 0)], "doc_id long, label int")
    found = classifier.classify(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in found if 400 <= r.doc_id < 600]
    assert sum(held) >= 0.97 * len(held)


def test_classifier_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [r.score for r in classifier.classify(docs, none).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    assert all(abs(r.score - 2 / 3) < 1e-12 for r in classifier.classify(docs, ones).collect())
    assert classifier.classify(docs.limit(0), ones).count() == 0


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.load_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


HARD = [
    None, "", " ", "a" * 3000, "\x00\x01 ▁▁hello ▁ <unk> <|endoftext|> <s>", "日本語 テキスト  😀👩‍👩‍👧\n\n\t x", "é" * 2000, "　 x\x85\x1c ᠎",
    "It's I'LL we'd  12345 ½Ⅷ² x_y __ --", "same", "same",
]


def test_codec_equals_the_reference_library(reference):
    import pyarrow as pa

    rng = random.Random(2)
    kinds = [(32, 127), (160, 0x3000), (0x1F300, 0x1F600), (0x4E00, 0x9000)]
    texts = HARD + ["".join(chr(rng.randrange(*rng.choice(kinds[:k]))) for _ in range(200)) for k in (1, 2, 3, 4) for _ in range(60)]
    tokens = bpe.load_ranks(PATH)
    codec = bpe.Codec(tokens, bpe.serialise(tokens), public_tokenizers.PATTERN)
    ids = codec.encode(pa.array(texts))
    assert ids.to_pylist() == [reference.encode_ordinary(t or "") for t in texts]
    assert codec.decode(ids).to_pylist() == [(t or "").encode() for t in texts]
    part = ids.slice(3, 4)
    assert codec.decode(part).to_pylist() == [t.encode() for t in texts[3:7]]


def test_encoding_documents(spark, reference):
    rows = [(i, t, [1], "x") for i, t in enumerate(HARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, lang string")
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert {r.doc_id: r.ids for r in coded.collect()} == {i: reference.encode_ordinary(t or "") for i, t in enumerate(HARD)}
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(coded.drop("text"), PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(HARD)}
    both = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert both.columns == ["doc_id", "lang", "ids", "decoded"] and both.count() == len(HARD)
    assert bpe.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    nulls = bpe.decode(spark.createDataFrame([(None,), ([],), ([7],)], "ids array<int>"), PATH).collect()
    assert [bytes(r.decoded) for r in nulls[:2]] == [b"", b""] and len(nulls[2].decoded) == 1


def test_rank_files_have_to_be_whole(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        bpe.load_ranks(str(bad))
