"""Groups that are mostly copies, and texts that stand out in one feature."""

import random

from clipyard.llm import robust_outliers as ro

SYLLABLES = ["ta", "so", "mi", "ren", "lo", "dus", "kar", "vel", "in", "o"]


def text(rng, lines=12, vary=True):
    """A clean text; length of words, capitals and symbols may differ from one to the next."""
    longest, capital, symbol = rng.uniform(1.5, 3.5), rng.uniform(0, 0.15), rng.uniform(0, 0.02)
    if not vary:
        longest, capital, symbol = 2.5, 0.05, 0.01

    def word():
        w = "".join(rng.choices(SYLLABLES, k=max(1, round(rng.uniform(1, longest)))))
        w = w + str(rng.randrange(100)) if rng.random() < 0.3 else w
        w = w.capitalize() if rng.random() < capital else w
        return w + "%" if rng.random() < symbol else w

    return "\n".join(" ".join(word() for _ in range(15)) for _ in range(lines))


def test_copies_and_lone_features(spark):
    """Three groups in one call: copies, near copies, texts that stand out in one feature."""
    rng = random.Random(21)
    base, plain = text(rng), text(rng, vary=False)
    near = [f"{plain} {a}{b}" for a in SYLLABLES for b in range(32)]
    groups = {
        "copies": [text(rng) for _ in range(80)] + [base] * 320,
        "near": [text(rng, vary=False) for _ in range(80)] + near,
        "alone": [text(rng) for _ in range(300)],
    }
    lines = text(rng) + "\nyes" * 20  # over half of the lines, a tenth of the words
    passage = " ".join(text(rng, 4).split()[:50])
    words = "\n".join([text(rng, 7), passage + " one", passage + " two"])
    one_line = text(rng) + "\n" + "\n".join([text(rng, 1)] * 2)
    odd = {"junk": ("copies", " ".join(f"{w}$$$" for w in base.split())), "junk near": ("near", " ".join(f"{w}$$$" for w in plain.split()))}
    odd |= {"lines": ("alone", lines), "words": ("alone", words), "one line": ("alone", one_line)}
    rows = [(f"{s} {i}", t, "en", s) for s, texts in groups.items() for i, t in enumerate(texts)]
    rows += [(name, t, "en", s) for name, (s, t) in odd.items()]
    docs = spark.createDataFrame(rows, "name string, text string, lang string, source string")
    got = {r.name: r for r in ro.judge(docs, carry=["name"]).collect()}
    assert not any(r.base_failed for r in got.values())
    assert not got["junk"].kept and not got["junk near"].kept
    assert {n for n, r in got.items() if not r.kept and n not in odd} == set()  # no text beside copies
    assert got["lines"].n_dup_lines == 19 and got["words"].n_repeat_words > 0.45 * got["words"].n_words
    assert got["lines"].distance < ro.CUTOFF and got["words"].distance < ro.CUTOFF  # not far in all features together
    assert not got["lines"].kept and not got["words"].kept and got["one line"].kept
