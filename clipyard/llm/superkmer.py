"""Removal of passages that an earlier document has, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. The minimiser of a window is
the smallest of its runs of ``RUN`` words in a fixed order; consecutive windows with
one minimiser travel as one packed string (a super-k-mer) to the bucket of that
minimiser, so a word is sent about three times, not thirteen. Equal windows have
equal minimisers and meet in one bucket, where sorting finds the equal ones exactly.

Balance. The order of runs puts rare runs first: all documents are counted into
``CELLS`` counters, and a run in a cell far above the mean ranks behind the others.
A phrase in a third of all documents is therefore nobody's minimiser as long as a
window holds anything else. Windows inside such a phrase are equal, and they are
combined before the shuffle: of equal super-k-mers a map batch sends only those of
its smallest document; the others are known to be removed. A bucket thus gets at most
one such string a batch, however many documents share it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.session import materialize

WINDOW = 13
RUN = 2
CELLS = 1 << 16
#: Text handled at once, and text whose super-k-mers are combined before they are sent.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 6 << 20
#: Packed bytes a bucket is meant to hold.
BUCKET_BYTES = 8 << 20
_CHUNK = 1 << 16  # words hashed at once
#: Blobs travel once and are large against other shuffles: a slower, denser level pays.
_LEVEL = 6

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n (kept between calls)."""
    if len(_powers.get(base, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        table = np.ones(size, np.uint64)
        done = 1
        while done < size:  # doubling: the next stretch is the last one times base**done
            table[done : 2 * done] = table[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _powers[base] = table
    return _powers[base][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of every word, from running sums over stretches of the buffer."""
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _CHUNK):
        a, b = starts[at : at + _CHUNK], ends[at : at + _CHUNK]
        own = flat[a[0] : b[-1]].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * _power(_BASE, len(own)), out=sums[1:])
        inverse = _power(_INVERSE, len(own) + 1)
        out[at : at + _CHUNK] = _mix((sums[b - a[0]] - sums[a - a[0]]) * inverse[a - a[0]])
    return out


def _sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (too few at the end: not used)."""
    out, n = hashes.copy(), len(hashes)
    for k in range(1, min(size, n)):
        out[: n - k] = out[: n - k] * np.uint64(_BASE) + hashes[k:]
    return _mix(out)


class Words:
    """The words of a few texts in one buffer, single spaces between them.

    ``starts``, ``ends``: bytes of each word; ``first``: number of the first word of
    each text, with the total at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        space = _SPACE[data]
        head = np.zeros(len(data) + 1, bool)
        head[offsets] = True  # a text starts here, or the buffer ends
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        before |= head[:-1]
        opens = ~space & before
        after = np.ones(len(data), bool)
        after[:-1] = space[1:]
        after |= head[1:]
        closes = ~space & after
        word_ends = np.flatnonzero(closes) + 1
        word_starts = np.flatnonzero(opens)
        sizes = word_ends - word_starts
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.flat = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
        inside = np.ones(len(self.flat), bool)
        inside[self.ends] = False
        self.flat[inside] = data[~space]
        self.first = np.searchsorted(word_starts, offsets)


def _slices(texts: pa.Array, size: int):
    """``Words`` of runs of texts of about ``size`` bytes, with the place of the first text."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(raw):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        own = offsets[at : end + 1]
        yield at, Words(data[own[0] : own[-1]], own - own[0])
        at = end


def _runs(words: Words):
    """Hash of the run of ``RUN`` words at each word, and whether it stays in its text."""
    runs = _sequence_hashes(_word_hashes(words.flat, words.starts, words.ends), RUN)
    n = len(runs)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.zeros(n, bool)
    if n >= RUN:
        whole[: n - RUN + 1] = text[: n - RUN + 1] == text[RUN - 1 :]
    return runs, whole, text


def run_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Runs of all documents by the cell of their hash, ``CELLS`` counters in all, and
    the bytes of their words."""

    def tally(batches):
        cells = np.zeros(CELLS + 1, np.int64)
        for batch in batches:
            for _, words in _slices(batch.column(0), SLICE_BYTES):
                cells[CELLS] += len(words.flat)
                runs, whole, _ = _runs(words)
                cells += np.bincount((runs[whole] % np.uint64(CELLS)).astype(np.int64), minlength=CELLS + 1)
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], ["cell", "n"])

    counts = np.zeros(CELLS + 1, np.int64)
    found = texts.mapInArrow(tally, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    for cell, n in found.collect():  # CELLS + 1 rows at most
        counts[cell] = n
    return counts[:CELLS], int(counts[CELLS])


def rank_table(counts: np.ndarray) -> np.ndarray:
    """0 for ordinary cells, one more for each doubling above twice the mean."""
    mean = max(1.0, counts.mean())
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / mean)), 0, 63).astype(np.uint64)


def super_kmers(words: Words, ranks: np.ndarray):
    """First word, number of windows, minimiser and text of every super-k-mer."""
    runs, _, text = _runs(words)
    order = (ranks[(runs % np.uint64(CELLS)).astype(np.int64)] << np.uint64(58)) | (runs >> np.uint64(6))
    n = len(order) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    inside = WINDOW - RUN + 1  # runs of a window
    least, width = order, 1
    while 2 * width <= inside:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < inside:
        least = np.minimum(least[: n], least[inside - width : inside - width + n])
    least = least[:n]
    whole = text[:n] == text[WINDOW - 1 :]
    breaks = np.ones(n, bool)
    breaks[1:] = (least[1:] != least[:-1]) | (text[1:n] != text[: n - 1]) | ~whole[:-1]
    at = np.flatnonzero(breaks & whole)
    bounds = np.flatnonzero(breaks | ~whole)
    following = np.append(bounds, n)[np.searchsorted(bounds, at, "right")]
    return at, following - at, least[at], text[at]


def _send(entries, buckets):
    """Rows of one map batch: known removals, and a compressed blob for each bucket.

    ``entries``: packed string -> (bucket, document, [(document key, row key, word, windows)]).
    """
    codec = pa.Codec("zstd", compression_level=_LEVEL)
    by_bucket: dict[int, list] = {}
    for packed, (bucket, _, places) in entries.items():
        by_bucket.setdefault(bucket, []).append((packed, places))
    for bucket, rows in by_bucket.items():
        places = np.array([p for _, own in rows for p in own], np.int64)
        repeats = np.array([len(own) for _, own in rows], np.int64)
        # By column: numbers of one kind side by side compress better.
        head = np.concatenate([[len(rows), len(places)], repeats, places.T.ravel()]).astype(np.int64)
        blob = head.tobytes() + b"\n".join(packed for packed, _ in rows)
        yield bucket, len(blob), codec.compress(blob, asbytes=True)


def _merged(ranges: np.ndarray) -> np.ndarray:
    """Ranges of one document that overlap or touch, as one."""
    ranges = ranges[np.lexsort((ranges[:, 2], ranges[:, 1], ranges[:, 0]))]
    same = np.zeros(len(ranges), bool)
    same[1:] = (ranges[1:, :2] == ranges[:-1, :2]).all(axis=1)
    out: list[list[int]] = []
    for (doc, key, word, n), joins in zip(ranges.tolist(), same.tolist()):
        if joins and word <= out[-1][2] + out[-1][3]:
            out[-1][3] = max(out[-1][3], word + n - out[-1][2])
        else:
            out.append([doc, key, word, n])
    return np.array(out, np.int64)


_SENT = "bucket bigint, size bigint, blob binary, doc_id bigint, row_key bigint, word bigint, words bigint"
_RANGE = "doc_id bigint, row_key bigint, word bigint, words bigint"


def _pack(ranks: np.ndarray, buckets: int):
    """Map side: documents in, super-k-mers by bucket and known removals out."""
    schema = pa.schema(
        [("bucket", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())]
        + [(c, pa.int64()) for c in ("doc_id", "row_key", "word", "words")]
    )

    def flush(entries, removed):
        sent = list(_send(entries, buckets))
        for at in range(0, len(sent), 64):
            part = sent[at : at + 64]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in part], pa.int64()),
                    pa.array([s for _, s, _ in part], pa.int64()),
                    pa.array([x for _, _, x in part], pa.binary()),
                    none, none, none, none,
                ],
                schema=schema,
            )
        if removed:
            known = _merged(np.array(removed, np.int64))
            # They need no bucket; any will do, and these are spread evenly.
            to = (_mix(known[:, 0].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            columns = [pa.array(to), pa.nulls(len(to), pa.int64()), pa.nulls(len(to), pa.binary())]
            columns += [pa.array(np.ascontiguousarray(known[:, k])) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        entries: dict[bytes, tuple] = {}
        removed: list[tuple] = []
        held = 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for first, words in _slices(batch.column(2), SLICE_BYTES):
                at, windows, least, text = super_kmers(words, ranks)
                flat = words.flat.tobytes()
                a = words.starts[at].tolist()
                b = words.ends[at + windows + WINDOW - 2].tolist()
                to = (_mix(least) % np.uint64(buckets)).astype(np.int64).tolist()
                word = (at - words.first[text]).tolist()
                docs, rows = ids[first + text].tolist(), keys[first + text].tolist()
                for x, y, bucket, doc, row, w, n in zip(a, b, to, docs, rows, word, windows.tolist()):
                    packed = flat[x:y]
                    known = entries.get(packed)
                    if known is None or doc < known[1]:
                        if known is not None:
                            removed += [(d, r, v, k + WINDOW - 1) for d, r, v, k in known[2]]
                        entries[packed] = (bucket, doc, [(doc, row, w, n)])
                    elif doc == known[1]:
                        known[2].append((doc, row, w, n))
                    else:
                        removed.append((doc, row, w, n + WINDOW - 1))
                held += len(flat)
                if held >= BATCH_BYTES:
                    yield from flush(entries, removed)
                    entries, removed, held = {}, [], 0
        yield from flush(entries, removed)

    return run


def _unpack(blobs: list[bytes]):
    """Entries of one bucket: words of the packed strings and the place of each entry."""
    strings, repeats, places = [], [], []
    for blob in blobs:
        n, m = np.frombuffer(blob, np.int64, 2)
        repeats.append(np.frombuffer(blob, np.int64, n, 16))
        places.append(np.frombuffer(blob, np.int64, 4 * m, 16 + 8 * n).reshape(4, m).T)
        strings.append(blob[16 + 8 * n + 32 * m :])
    text = b"\n".join(strings)
    data = np.frombuffer(text, np.uint8)
    offsets = np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]])
    return Words(data, offsets), np.concatenate(repeats), np.concatenate(places)


def _equal_groups(flat: bytes, starts, ends, hashes):
    """Number the windows so that exactly the equal ones share a number."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    # Compare the text of neighbours; a hash that two texts share gets more numbers.
    pairs = np.flatnonzero(~new)
    x, y = order[pairs - 1], order[pairs]
    same = zip(starts[x].tolist(), ends[x].tolist(), starts[y].tolist(), ends[y].tolist())
    clash = {int(group[v]) for v, (a, b, c, d) in zip(y, same) if flat[a:b] != flat[c:d]}
    top = int(group.max()) + 1
    for g in clash:
        numbers: dict[bytes, int] = {}
        for i in np.flatnonzero(group == g).tolist():
            group[i] = numbers.setdefault(flat[starts[i] : ends[i]], top + len(numbers))
        top += len(numbers)
    return group


def removed_words(blobs: list[bytes]) -> np.ndarray:
    """Ranges ``(document, row key, first word, words)`` to remove, from one bucket."""
    words, repeats, places = _unpack(blobs)
    text = np.repeat(np.arange(len(repeats)), np.diff(words.first))
    n = len(text) - WINDOW + 1
    whole = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    starts, ends = words.starts[whole], words.ends[whole + WINDOW - 1]
    flat = words.flat.tobytes()
    hashes = _sequence_hashes(_word_hashes(words.flat, words.starts, words.ends), WINDOW)
    group = _equal_groups(flat, starts, ends, hashes[whole])
    doc = places[np.cumsum(repeats) - 1, 0]  # all places of a string are of one document
    own = doc[text[whole]]
    least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, own)
    hit = whole[least[group] < own]
    if not len(hit):
        return np.zeros((0, 4), np.int64)
    # Windows that follow each other in one string make one range.
    fresh = np.ones(len(hit), bool)
    fresh[1:] = (hit[1:] != hit[:-1] + 1) | (text[hit[1:]] != text[hit[:-1]])
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(hit)))
    string = text[hit[at]]
    shift = hit[at] - words.first[string]
    before = np.cumsum(repeats) - repeats
    index = np.repeat(np.arange(len(at)), repeats[string])
    inner = np.arange(len(index)) - np.repeat(np.cumsum(repeats[string]) - repeats[string], repeats[string])
    place = places[before[string[index]] + inner]
    return np.stack(
        [place[:, 0], place[:, 1], place[:, 2] + shift[index], count[index] + WINDOW - 1], axis=1
    )


def _judge(batches):
    """Bucket side: rows sorted by bucket in, ranges to remove out; one bucket in memory."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "row_key", "word", "words")])

    def out(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(found[:, k])) for k in range(4)], schema=schema
        )

    bucket, blobs = None, []
    for batch in batches:
        known = batch.filter(batch.column(2).is_null())
        if known.num_rows:
            yield pa.RecordBatch.from_arrays([known.column(k) for k in range(3, 7)], schema=schema)
        sent = batch.filter(batch.column(2).is_valid())
        for b, size, blob in zip(*[sent.column(k).to_pylist() for k in range(3)]):
            if b != bucket and blobs:
                yield out(removed_words(blobs))
                blobs = []
            bucket = b
            blobs.append(pa.decompress(blob, size, "zstd", asbytes=True))
    if blobs:
        yield out(removed_words(blobs))


@F.arrow_udf(
    T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
)
def _cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    """Words, removed words and what is left of each text, words joined by a space."""
    words_out, removed_out, kept_out = [], [], []
    for text, spans in zip(texts.cast(pa.large_binary()), ranges):
        words = (text.as_py() or b"").split()
        gone = np.zeros(len(words) + 1, np.int64)
        for span in spans.as_py() or ():
            gone[span["word"]] += 1
            gone[span["word"] + span["words"]] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        words_out.append(len(words))
        removed_out.append(len(words) - int(keep.sum()))
        kept_out.append(b" ".join(w for w, k in zip(words, keep.tolist()) if k))
    return pa.StructArray.from_arrays(
        [pa.array(words_out, pa.int64()), pa.array(removed_out, pa.int64()), pa.array(kept_out, pa.binary()).cast(pa.string())],
        ["n_words", "n_removed", "kept"],
    )


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, word, words``: words covered by windows that a smaller id has.

    Ranges may overlap. ``row_key`` is ``xxhash64`` of the text and tells apart rows
    that share an id. Rows with a null id are neither judged nor do they count.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("row_key"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("doc_id is not null and text is not null")
    counts, size = run_counts(rows.select("text"))
    ranks = rank_table(counts)
    sent = 3 * size
    buckets = max(1, -(-sent // BUCKET_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Pruned scans are dealt in file order, so a batch holds neighbouring documents.
    packed = rows.mapInArrow(_pack(ranks, buckets), _SENT)
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_judge, _RANGE)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word is removed if a window of 13
    words covers it whose words also start in a row with a smaller id; all windows are
    judged on the input. ``kept`` joins the other words by one space. A null text
    counts as empty. A row with a null id keeps everything and is no one's smaller id;
    rows that share an id do not remove each other's words. Texts under 13 words are
    kept. Other columns are ignored; an empty table gives no rows.
    """
    ranges = (
        repeated_ranges(docs, id_col, text_col)
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list(F.struct("word", "words")).alias("ranges"))
    )
    ranges = materialize(ranges, "repeats")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("row_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    joined = rows.join(ranges, ["doc_id", "row_key"], "left")
    return joined.select("doc_id", _cut("text", "ranges").alias("c")).select("doc_id", "c.*")
