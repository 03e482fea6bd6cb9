import functools
import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from clipyard.llm import sentencepiece_unigram as sp  # noqa: E402
from clipyard.llm.queries import tokenizer_path  # noqa: E402

PATH = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "", "a", " a", "a ", "a  b", "   ", "x\ny\t z", "日本語 テキスト", "🙂 ok\x00", "Ünï ́", "the thing, then.", "w" * 300, "é" * 200 + " q",
    "a \n b", "one two\n\nthree", "long " * 2000, "0123 4.5",
]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return sp.Model(file.read())


def best_score(model, text):
    """Highest score of any segmentation, straight from the definition."""
    text = text.encode()
    pieces = {p.encode(): s for p, s, v in zip(model.pieces, model.scores, range(len(model.pieces))) if v >= 259}

    @functools.lru_cache(None)
    def best(at):
        if at == len(text):
            return 0.0
        step = next(n for n in (1, 2, 3, 4) if at + n == len(text) or text[at + n] & 0xC0 != 0x80)
        options = [pieces[text[at:b]] + best(b) for b in range(at + 1, min(len(text), at + 48) + 1) if text[at:b] in pieces]
        if text[at : at + step] not in pieces:
            options.append(model.unknown + best(at + step))
        return max(options)

    return best(0)


def score_of(model, ids):
    total = k = 0
    while k < len(ids):
        if 3 <= ids[k] < 259:  # the byte pieces of one character
            lead = ids[k] - 3
            k += 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            total += model.unknown
        else:
            total += model.scores[ids[k]]
            k += 1
    return total


def test_paths_are_optimal(model):
    rng = random.Random(1)
    texts = TEXTS[:11] + ["".join(rng.choices("theraning lqéx\n🙂", k=rng.randrange(1, 25))) for _ in range(300)]
    for text, ids in zip(texts, model.encode(pa.array(texts)).to_pylist()):
        marked = ("▁" + text.replace(" ", "▁")) if text else ""
        assert score_of(model, ids) == pytest.approx(best_score(model, marked))
        assert model.decode(ids) == text


def test_never_worse_than_the_library(model):
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1  # the same pieces, searched as a unigram model
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(2)
    words = ["".join(rng.choices(["th", "er", "ing", "a", "on", "é", "st", "ou"], k=rng.randrange(1, 6))) for _ in range(1500)]
    mine, theirs = model.encode(pa.array(words)).to_pylist(), library.encode(words)
    assert all(score_of(model, a) >= score_of(model, b) for a, b in zip(mine, theirs))
    assert sum(a == b for a, b in zip(mine, theirs)) > 0.95 * len(words)
    assert all(model.decode(a) == library.decode(a) for a in mine)


def test_words_side_by_side_or_alone(model):
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choices("abcdetéß日🙂\n", k=rng.randrange(0, 20))) for _ in range(400)]
    assert [np.frombuffer(x, np.int32).tolist() for x in model.search_many([w.encode() for w in words])] == [model.search(w.encode()) for w in words]


def test_trie_holds_its_keys_only():
    rng = random.Random(4)
    keys = sorted({bytes(rng.choices(b"abc\xff", k=rng.randrange(1, 6))) for _ in range(300)})
    base, check, value = sp.build_trie([(k, i) for i, k in enumerate(keys)])

    def look(key):
        state = 0
        for c in key:
            child = base[state] + c + 1
            if child >= len(check) or check[child] != state:
                return -1
            state = child
        return value[state]

    assert [look(k) for k in keys] == list(range(len(keys)))
    for _ in range(2000):
        key = bytes(rng.choices(b"abcd\x00\xff", k=rng.randrange(1, 7)))
        assert look(key) == (keys.index(key) if key in keys else -1)


def test_documents(spark, model):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (5, "mark ▁ in text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = sp.encode_documents(docs, PATH)
    got = sp.decode_documents(encoded, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert r.ids == (model.encode(pa.array([r.text], pa.string())).to_pylist()[0])
    assert sp.encode_documents(docs.limit(0), PATH).count() == 0
