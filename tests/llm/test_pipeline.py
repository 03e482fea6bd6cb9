"""The pipeline against the plain versions of its stages, one after the other."""

import random
import re
import sys
from pathlib import Path

import pyarrow as pa

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_quality_outliers import plain_judge  # noqa: E402
from test_sentencepiece import PATH  # noqa: E402
from test_simhash import brute_fingerprint  # noqa: E402

import corpus_pipeline  # noqa: E402
from clipyard.llm import sentencepiece_unigram as sp  # noqa: E402


def plain_pipeline(docs, items):
    docs = [d for d, (_, _, kept) in zip(docs, plain_judge([(d[2], d[3], d[1]) for d in docs])) if kept]
    prints = [brute_fingerprint(d[1]) for d in docs]
    group = list(range(len(docs)))
    for _ in docs:  # smallest label until nothing moves
        new = [min(group[j] for j in range(len(docs)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(docs))]
        if new == group:
            break
        group = new
    first = {}
    for i, d in enumerate(docs):
        key = (d[0] is None, d[0] or 0)
        if group[i] not in first or key < first[group[i]][0]:
            first[group[i]] = (key, d)
    docs = [d for _, d in first.values()]
    docs = [d for d in docs if not brute.contained([(0, d[1])], items)]
    out = []
    for doc_id, text, lang, source, _ in docs:
        spans = sorted((a, b, k) for k, a, b in brute.pii(text))
        for a, b, k in reversed(spans):
            text = text[:a] + f"[{k.upper()}]" + text[b:]
        out.append((doc_id, text, lang, source, len(text)))
    return out


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices(["ta", "so", "mi", "ren", "lo", "dus"], k=rng.randrange(1, 4))) for _ in range(400)]

    def text(n):
        return ".\n".join(" ".join(rng.choices(vocabulary, k=12)).capitalize() for _ in range(n // 12))

    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(10)]
    rows = []
    for i in range(260):
        t = text(rng.randrange(70, 300))
        t += rng.choice(["", "", f" mail me.{i}@x.org now", " host 10.0.0.1 ", " " + items[i % 10][1] if i % 5 == 0 else ""])
        rows.append((i, t, rng.choice(["en", "de"]), "s", len(t)))
    for i in range(40):
        words = rows[i][1].split(" ")
        words[5] = rng.choice(vocabulary)
        rows.append((1000 + i, " ".join(words), "en", "s", 1))
    rows += [(2000 + i, rows[3][1], "en", "s", 2) for i in range(20)] + [(None, text(100), None, None, None), (7000, None, "en", "s", 0), (7001, "", "en", "s", 0)]
    rows += [(8000, " ".join(f"{w}$$$" for w in text(120).split()), "en", "s", 3), (rows[9][0], rows[9][1], "en", "s", 4)]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    with open(PATH, "rb") as file:
        model = sp.Model(file.read())
    want = plain_pipeline(rows, items)
    assert 150 < len(want) < len(rows) - 40  # every stage takes some
    expected = sorted(((d, n, model.encode(pa.array([t])).to_pylist()[0]) for d, t, _, _, n in want), key=str)
    assert sorted(((r.doc_id, r.n_chars, r.ids) for r in got), key=str) == expected
    assert all(r.n_pieces == len(r.ids) for r in got)
    assert not any(re.search("me\\.[0-9]+@x", model.decode(r.ids)) for r in got)


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
