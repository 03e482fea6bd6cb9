"""IBANs by their definition: every start, every end of a word, ISO 7064 mod 97."""

import random

from clipyard.llm import pii

LENGTHS = {c: n for n, codes in pii.IBAN_LENGTHS.items() for c in codes.split()}


def is_iban(value):
    number = "".join(str(int(c, 36)) for c in value[4:] + value[:4])
    return 15 <= len(value) <= 34 and int(number) % 97 == 1


def plain_ibans(text):
    def alnum(c):
        return c.isascii() and c.isalnum()

    out, at = [], 0
    while at < len(text):
        best = None
        head = text[at : at + 4]
        starts = len(head) == 4 and all("A" <= c <= "Z" for c in head[:2]) and all("0" <= c <= "9" for c in head[2:])
        if starts and not (at and alnum(text[at - 1])):
            value, end = "", at
            while end < len(text) and len(value) < 34:
                c = text[end]
                if c == " " and end - at >= 4 and text[end - 1] != " ":
                    end += 1
                    continue
                if not (alnum(c) and c == c.upper()):
                    break
                value, end = value + c, end + 1
                if not (end < len(text) and alnum(text[end])) and is_iban(value):
                    best = max(best or (False, 0), (LENGTHS.get(value[:2]) == len(value), end))
        if best:
            out.append((at, best[1]))
            at = best[1]
        else:
            at += 1
    return out


def iban_of(body, code):
    number = "".join(str(int(c, 36)) for c in body + code + "00")
    return f"{code}{98 - int(number) % 97:02d}{body}"


def test_ibans_end_at_the_end_of_a_word(spark):
    rng = random.Random(12)
    fixed = {
        "IBAN DE89 3704 0044 0532 0130 00 Thanks": (5, 32),
        "IBAN DE89370400440532013000 Please": (5, 27),
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF": (5, 32),
        "GB82WEST12345698765432 2024": (0, 22),
        "REF AB12 DE89 3704 0044 0532 0130 00": (9, 36),
    }
    words = ["Thanks", "BIC", "COBADEFF", "2024", "AB12", "é", "x", "\n", "12", "IBAN", "DE89", "a1", "NO93"]
    texts = list(fixed)
    for _ in range(400):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            code = rng.choice(["DE", "GB", "NO", "MT", "FR", "ZZ"])
            n = LENGTHS.get(code, rng.randrange(15, 35))
            value = iban_of("".join(rng.choices("0123456789ABCXYZ", k=n - 4)), code)
            if rng.random() < 0.2:
                value = value[:-1] + rng.choice("0123456789")
            if rng.random() < 0.5:
                value = " ".join(value[i : i + 4] for i in range(0, n, 4))
            parts += [value, *rng.choices(words, k=rng.randrange(3))]
        texts.append(rng.choice([" ", " ", " ", ", ", ""]).join(parts))
    texts += ["", "AB12", "AB12 " * 3000, "DE89 3704 0044 0532 0130 00 " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {texts[r.doc_id]: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(docs).collect()}
    assert {t: found[t] for t in fixed} == {t: [span] for t, span in fixed.items()}
    assert {t: found[t] for t in texts} == {t: plain_ibans(t) for t in texts}
    masked = pii.mask_pii(pii.find_pii(docs.filter("doc_id = 0"))).first().text
    assert masked == "IBAN [IBAN] Thanks"
