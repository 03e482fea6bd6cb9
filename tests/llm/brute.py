"""Plain Python versions of the operators, written from their definitions."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def warc(rows, least=0):
    """rows: (page_id, html)."""
    groups = defaultdict(list)
    for page, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, html in rows:
        html = html or ""
        ids = [p for p in groups[html] if p is not None]
        top = max(ids, default=None) if len(html.encode()) >= least else None
        revisit = top is not None and page != top
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        out.append((page, len(html.encode()), digest, "revisit" if revisit else "response", top if revisit else None))
    return out


def chat(rows):
    """rows: (conv_id, turn, role, text) -> conv_id, n_turns, turns_sha256, loss_chars, loss_sha256."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss)))
    return out


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    """Base spans: (kind, start, end)."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def contained(docs, items, threshold=0.8):
    """Pairs (doc_id, item_id) -> (shared, shingles)."""

    def sets(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        if len(w) < 5:
            return {" ".join(w)} if w else set()
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}

    shingled = defaultdict(set)
    for item, text in items:
        shingled[item] |= sets(text)
    out = {}
    for doc, text in docs:
        own = sets(text)
        for item, wanted in shingled.items():
            if wanted and len(own & wanted) >= threshold * len(wanted) - 1e-9:
                out[doc, item] = (len(own & wanted), len(wanted))
    return out


def repeats(rows, n=13):
    """rows: (doc_id, text) -> (doc_id, n_words, n_removed, kept)."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - n + 1):
            if doc is not None:
                key = tuple(w[i : i + n])
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            if doc is not None and first[tuple(w[i : i + n])] < doc:
                gone |= set(range(i, i + n))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


EXTRA = {
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social|security|taxpayer"),
    "secret": (r"(?<![A-Za-z0-9])[0-9a-f]{32,64}+(?![A-Za-z0-9])", 0.3, "token|secret|password|key|api"),
}


def pii_all(text):
    """Base spans and those of the further kinds."""
    from test_iban import plain_ibans  # IBANs by their definition; a score of 0.95 needs no context

    out, text = pii(text), text or ""
    out += [("iban", a, b) for a, b in plain_ibans(text)]
    for kind, (pattern, score, near) in EXTRA.items():
        found = list(re.finditer(pattern, text))
        for i, m in enumerate(found):
            before = text[found[i - 1].end() if i else 0 : m.start()][-40:]
            after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][:20]
            if kind == "ssn" and re.search("^(?:000|666|9)|-00-|-0000$", m[0]):
                continue
            if score + 0.35 * bool(re.search(rf"(?<![a-z0-9])(?:{near})(?![a-z0-9])", f"{before} {after}".lower())) >= 0.5:
                out.append((kind, m.start(), m.end()))
    return out
