"""Operators that judge rows or groups of rows, against the plain versions in ``brute``."""

import io
import random
import struct
import sys
import zipfile
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from clipyard.llm import chat, decontaminate, histogram_sort, pii, superkmer, token_counts, warc  # noqa: E402
from clipyard.llm.queries import PROBE_TEXT, tokenizer_path  # noqa: E402


def as_set(rows):
    return sorted(map(tuple, rows), key=str)


# --- WARC packages


def test_warc_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, f"https://a.org/{i} x", rng.choice(["<p>é</p>" * 9, "", None, "z" * 5, str(i), "<a>\r\n\r\n</a>"])) for i in range(60)]
    rows += [(None, "u\nv", "z" * 5), (None, None, "alone"), (7, "again", rows[7][2]), (99, "big", "word " * 400000)]
    pages = spark.createDataFrame([(p, u, h, 1) for p, u, h in rows], "page_id long, url string, html string, digest int")
    for least in (0, 6):
        packages = warc.write_packages(pages, min_revisit_bytes=least)
        got = warc.read_packages(packages)
        columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        found = got.select(*columns, "payload").collect()
        assert as_set(r[:5] for r in found) == as_set(brute.warc([(p, h) for p, _, h in rows], least))
        assert all(r.payload is None if r.record_type == "revisit" else len(r.payload) == r.payload_bytes for r in found)
    assert warc.read_packages(warc.write_packages(pages.limit(0))).count() == 0


def test_zip_directories():
    with io.BytesIO() as out:
        with zipfile.ZipFile(out, "w") as z:  # over 65,535 members: a ZIP64 directory
            for i in range(66000):
                z.writestr(f"m/{i}", b"x" * (i % 3))
            z.writestr("packed", b"y" * 100, zipfile.ZIP_DEFLATED)
        data = out.getvalue()
        members = warc.stored_members(io.BytesIO(data), len(data))
        assert len(members) == 66000 and "packed" not in members
        assert all(data[a : a + n] == b"x" * (i % 3) for i in (0, 1, 65999) for a, n in [members[f"m/{i}"]])


def test_zip64_fields_of_an_entry():
    body = b"hello"
    local = struct.pack("<4sHHHHHLLLHH", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 0) + b"a"
    data = local + body
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4sHHHHHHLLLHHHHHLL", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    entry += b"a" + extra
    at = len(data)
    end64 = struct.pack("<4sQHHLLQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    data += entry + end64 + struct.pack("<4sLQL", b"PK\6\7", 0, at + len(entry), 1)
    data += struct.pack("<4sHHHHLLH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert warc.stored_members(io.BytesIO(data), len(data)) == {"a": (len(local), 5)}
    with pytest.raises(ValueError):
        warc.stored_members(io.BytesIO(b"no zip"), 6)


def test_records_without_an_index():
    records = [warc.encode_record({"WARC-Type": "response"}, b"a" * n) for n in (0, 10, 3 << 20)]
    with io.BytesIO() as out:
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("archive/x.warc.gz", b"".join(records))
        data = out.getvalue()
    places = list(warc.record_places(io.BytesIO(data), len(data)))
    assert [data[a : a + n] for a, n in places] == records


# --- shards


def test_shards(spark):
    rng = random.Random(2)
    hot = "hot " * 30
    rows = [(i, hot if i % 3 == 0 else rng.choice(["x", "yy"]) * rng.randrange(200)) for i in range(3000)]
    rows += [(None, None), (None, ""), (5, hot), (5, hot)]
    docs = spark.createDataFrame([(d, t, 9, 9) for d, t in rows], "doc_id long, text string, shard int, size int")
    got = histogram_sort.shard_by_bytes(docs, 7).select("doc_id", "text", "size", "shard", "slot").collect()
    assert as_set((r.doc_id, r.text, r.size) for r in got) == as_set((d, t, len((t or "").encode()) + 16) for d, t in rows)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(7)]
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 7
    for s in range(7):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    cut = {t for t in {r.text for r in got} if len({r.shard for r in got if r.text == t}) > 1}
    slack = histogram_sort.TOLERANCE * sum(sizes) / 7
    assert hot in cut and all(sum(r.size for r in got if r.text == t) > slack for t in cut)
    assert histogram_sort.shard_by_bytes(docs.limit(0), 7).count() == 0
    assert histogram_sort.shard_by_bytes(docs.limit(2), 7).count() == 2


# --- token counts


def test_token_counts(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    texts = [
        "", " ", "  ", "a", " a", "a ", "a  b", "a\n\nb \n c", "x <|endoftext|> y<|endoftext|>", "don't  stop", "\u00a0 x\u00a0y",
        "é ü 日本 語", "🙂 🙂", "1 234  5", "tab\t \tend ", "w" * 5000, "a b " * 9000, "\x85 q", "\u2003 em\u3000 x", "e\u0301 e", "\u200b z \u200b",
    ]
    rng = random.Random(3)
    texts += ["".join(rng.choices("ab .,\n\t1é\u00a0'", k=60)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, None, "c")], "doc_id long, text string, n_tokens string")
    tokenizer = Tokenizer.from_file(path)
    want = [(i, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False)), n > 512) for i, t in enumerate(texts)]
    got = token_counts.count_tokens(docs, path).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert as_set(got.collect()) == as_set([*want, (None, 0, 0, False)])
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


# --- decontamination


def test_contained_items(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 14, 40, 60])))) for i in range(40)]
    docs = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.choice([3, 50, 400]))
        if i % 2:
            part = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = part
        docs.append((i, rng.choice([" ", "\n", ", "]).join(words).title()))
    docs += [(900, items[0][1]), (901, None), (902, ""), (903, "..."), (None, items[5][1]), (900, items[1][1])]
    items += [(50, None), (51, " "), (3, "more words for the same item number three"), (52, items[9][1])]
    spark_docs = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    spark_items = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contained(spark_docs, spark_items)
    found = as_set(got.select("doc_id", "item_id", "n_shared", "n_shingles").collect())
    want = [(d, i, *v) for d, t in docs for (_, i), v in brute.contained([(d, t)], items).items()]
    assert found == as_set(want) and len(found) >= 40
    kept = decontaminate.drop_contaminated(spark_docs, spark_items)
    assert as_set(kept.select("doc_id", "text").collect()) == as_set((d, t) for d, t in docs if not brute.contained([(d, t)], items))
    assert decontaminate.find_contained(spark_docs, spark_items.limit(0)).count() == 0
    assert decontaminate.find_contained(spark_docs.limit(0), spark_items).count() == 0


# --- chat


def test_chat(spark):
    rng = random.Random(5)
    texts = [None, "", "a\\b", "<|im_end|>", "\\<|", "<\\|im_start|>\n", PROBE_TEXT, "é🙂\n", "\\\\n"]
    roles = ["user", "assistant", "system", None, "to\nol", "a<|im_end|>\\n"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (40, 1, "user", "q"), (40, 1, "assistant", "b"), (40, 1, "assistant", "a")]
    rows += [(41, i, ("user", "assistant")[i % 2], "long " * 1000) for i in range(500)]
    turns = spark.createDataFrame([(*r, True) for r in rows], "conv_id long, turn long, role string, text string, loss boolean")
    segments = chat.format_chat(turns)
    got = chat.read_back(segments)
    assert as_set(got.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()) == as_set(brute.chat(rows))
    valid = {r.conv_id: r.order_valid for r in got.collect()}
    assert valid[41] and not valid[40]
    shown = [r for r in segments.collect() if not r.loss]
    assert all(r.segment.count("<|") <= 1 for r in shown)  # only the template's own control strings
    assert chat.read_back(chat.format_chat(turns.limit(0))).count() == 0


def test_escaping_is_reversible():
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choices("\\<|n\nim_end>", k=rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


# --- personal data


def test_pii(spark):
    rng = random.Random(7)
    card = "4539 1488 0343 6467"
    bits = [
        "a.b+c@x-y.co.uk", "x@y.z_w@q.r", "a@b", "a@b..c", "@@a@b.c@d.e", "1.2.3.4", "256.1.1.1", "001.2.3.04", "1.2.3.4.5.6.7.8", card,
        card.replace(" ", "-"), "4539148803436468", "+1 (555) 555-0100", "+1234567", "+1.....2", "++4912345678.", "é", " ", "\n", "word", "12", "0" * 30,
        "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82WEST12345698765433", "ssn 123-45-6789", "123-45-6789", "token = \"" + "ab12" * 10 + "\"",
    ]
    texts = ["".join(rng.choices(bits, k=rng.randrange(8))) for _ in range(500)] + bits + [None, "", "7 " * 40000, "a" * 100000 + "@b.cc", "1." * 30000]
    texts += ["m@n.io " * 700]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = pii.find_pii(docs)
    rows = found.select("doc_id", "spans", pii.span_list(found["spans"], True), pii.span_list(found["spans"])).collect()
    kinds = set()
    for row in rows:
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii(texts[row.doc_id]))
        everything = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii_all(texts[row.doc_id]))
        assert row[2] == want and row[3] == everything
        kinds |= {s.kind for s in row.spans}
    assert kinds == {k.name for k in pii.KINDS}
    spans = {texts[r.doc_id]: {(s.kind) for s in r.spans} for r in rows}
    assert "iban" in spans["GB82WEST12345698765432"] and "iban" not in spans["GB82WEST12345698765433"]
    assert "ssn" in spans["ssn 123-45-6789"] and "ssn" not in spans["123-45-6789"]
    masked = {r.doc_id: r.text for r in pii.mask_pii(found).collect()}
    for row in rows:
        text, out, at = texts[row.doc_id], "", 0
        for start, end, kind in sorted((s.start, s.end, s.kind) for s in row.spans):
            if start >= at:
                out += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        assert masked[row.doc_id] == (None if text is None else out + text[at:])
    assert pii.find_pii(docs.limit(0)).count() == 0


# --- repeated passages


def test_repeats(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)] + ["é", "日本"]
    passages = [" ".join(rng.choices(vocabulary, k=k)) for k in (12, 13, 14, 30, 80)]
    common = " ".join(rng.choices(vocabulary, k=20))
    rows = []
    for i in range(250):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(40)))]
        parts += [rng.choice(passages) for _ in range(rng.randrange(3))]
        parts += [common] if i % 3 == 0 else []
        parts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(20))))
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n \t"]).join(parts)))
    rows += [(-5, "a " * 300), (4, "a " * 400), (5, "x a " * 90), (None, rows[0][1]), (None, None), (6, None), (7, ""), (8, "\x0b\x0c "), (rows[3][0], rows[3][1]), (rows[4][0], rows[5][1])]
    rows += [(9 + i, passages[4]) for i in range(40)] + [(10**7, " ".join(rng.choices(vocabulary, k=60000)) + " " + common)]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, kept string").repartition(5)
    got = superkmer.drop_repeats(docs).collect()
    assert as_set(got) == as_set(brute.repeats(rows))
    assert superkmer.drop_repeats(docs.limit(0)).count() == 0


def test_hash_clashes_are_told_apart():
    flat = b"aa bb aa cc"
    starts, ends = [0, 3, 6, 9], [2, 5, 8, 11]
    import numpy as np

    group = superkmer._equal_groups(flat, np.array(starts), np.array(ends), np.zeros(4, np.uint64))
    assert group[0] == group[2] and len(set(group.tolist())) == 3


def test_crc_is_the_standard_one(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.crc32(F.lit("é").cast("binary"))).first()[0] == zlib.crc32("é".encode())
