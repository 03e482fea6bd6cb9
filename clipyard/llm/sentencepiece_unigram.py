"""Encoding and decoding by a SentencePiece vocabulary, as a unigram model.

The best segmentation is the path of the highest sum of piece scores (Viterbi) over a
double-array trie of the pieces' UTF-8 bytes. Characters no piece covers fall back to
byte pieces; spaces are written as the marker U+2581 and read back from it.

No piece holds a marker behind another character, so the best path of a text is that
of its marked words one after the other. A batch is cut into words, every distinct word
is searched once, all words of a batch side by side in numpy, and workers remember
words. The model file is an argument; its pieces, scores and types are read here.
"""

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.llm.token_counts import slices_by_bytes

MARK = "▁"
# Piece types of the model format, and its penalty for unknown characters.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Text handled at once; words searched side by side; longest word searched that way.
SLICE_BYTES = 2 << 20
#: Piece ids decoded in one block.
DECODE_IDS = 1 << 20
GROUP_WORDS = 8192
GROUP_BYTES = 96
KEPT_WORDS = 1_000_000


def _fields(data: bytes):
    """``(number, value)`` of the fields of a protocol-buffer message."""

    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def build_trie(keys: list[tuple[bytes, int]]):
    """Double array over bytes: ``base, check, value``.

    The child of state s by byte c is ``t = base[s] + c + 1`` if ``check[t] == s``;
    ``value[t]`` is the key that ends there, or -1.
    """
    root: dict = {}
    for key, number in keys:
        node = root
        for byte in key:
            node = node.setdefault(byte, {})
        node[-1] = number
    base, check, value = [0], [0], [-1]  # state 0 is the root
    used, free, top, queue = bytearray(b"\1"), 1, 1, [(0, root)]
    for state, node in queue:
        labels = sorted(c for c in node if c >= 0)
        if not labels:
            continue
        while free < len(used) and used[free]:
            free += 1
        # A lone child takes the first free cell; a few tries for more, else behind all.
        at = max(0, free - labels[0] - 1)
        for _ in range(1 if len(labels) == 1 and free > labels[0] else 64):
            if at + labels[-1] + 1 >= len(used):
                fill = at + 512 - len(used)
                used.extend(bytes(fill))
                base += [0] * fill
                check += [-1] * fill
                value += [-1] * fill
            if not any(used[at + c + 1] for c in labels):
                break
            at += 1
        else:
            at = max(0, top - labels[0] - 1)
            fill = max(0, at + 512 - len(used))
            used.extend(bytes(fill))
            base += [0] * fill
            check += [-1] * fill
            value += [-1] * fill
        base[state] = at
        for c in labels:
            child = at + c + 1
            used[child] = 1
            check[child] = state
            value[child] = node[c].get(-1, -1)
            queue.append((child, node[c]))
        top = max(top, at + labels[-1] + 2)
    return np.array(base, np.int32), np.array(check, np.int32), np.array(value, np.int32)


class Model:
    """Pieces, scores and trie of one SentencePiece model file."""

    def __init__(self, content: bytes):
        self.pieces, scores, kinds = [], [], []
        prefix = squeeze = True
        for number, value in _fields(content):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("models with a character map are not supported")
                prefix, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        self.add_prefix, self.squeeze = prefix, squeeze
        self.scores = np.array(scores)
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER_DEFINED, UNUSED)]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in usable):
            raise ValueError("a piece holds the marker behind another character")
        ranked = [self.scores[i] for i in usable if kinds[i] == NORMAL]
        self.unknown = (min(ranked) if ranked else 0.0) - UNKNOWN_PENALTY
        self.unknown_id = kinds.index(UNKNOWN)
        self.bytes = np.full(256, -1, np.int32)
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.bytes[int(self.pieces[i][3:5], 16)] = i
        self.fallback = bool((self.bytes >= 0).all())
        self.base, self.check, self.value = build_trie([(self.pieces[i].encode(), i) for i in usable])
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, kinds)
        ]
        self.known: dict[str, bytes] = {}

    def search(self, word: bytes) -> list[int]:
        """Best pieces of one marked word, a byte at a time (any length)."""
        n = len(word)
        best, start, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, value, scores = self.base, self.check, self.value, self.scores
        at = 0
        while at < n:
            lead = word[at]
            step = min(1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4, n - at)
            state, single, j = 0, False, at
            while j < n:
                child = int(base[state]) + word[j] + 1
                if child >= len(check) or check[child] != state:
                    break
                state, j = child, j + 1
                found = int(value[state])
                if found >= 0:
                    single |= j - at == step
                    score = best[at] + scores[found]
                    if score > best[j]:
                        best[j], start[j], piece[j] = score, at, found
            if not single and best[at] + self.unknown > best[at + step]:
                best[at + step], start[at + step], piece[at + step] = best[at] + self.unknown, at, -1
            at += step
        out, at = [], n
        while at > 0:
            if piece[at] >= 0:
                out.append(piece[at])
            elif self.fallback:
                out.extend(int(self.bytes[b]) for b in reversed(word[start[at] : at]))
            else:
                out.append(self.unknown_id)
            at = start[at]
        return out[::-1]

    def search_many(self, words: list[bytes]) -> list[bytes]:
        """Best pieces of words of similar length side by side; ids as int32 bytes."""
        n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max())
        letters = np.zeros((n, width), np.uint8)
        letters[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        start, piece = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        base, check, value, scores = self.base, self.check, self.value, self.scores
        for at in range(width):
            lead = letters[:, at]
            rows = np.flatnonzero((sizes > at) & ((lead & 0xC0) != 0x80))
            if not len(rows):
                continue
            own = lead[rows]
            step = np.where(own < 0xC0, 1, np.where(own < 0xE0, 2, np.where(own < 0xF0, 3, 4)))
            step = np.minimum(step, sizes[rows] - at)
            single = np.zeros(len(rows), bool)
            live, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for j in range(at, width):
                row = rows[live]
                child = base[state] + letters[row, j].astype(np.int32) + 1
                child[child >= len(check)] = 0
                ok = (check[child] == state) & (child > 0) & (j < sizes[row])
                live, state = live[ok], child[ok]
                if not len(live):
                    break
                found = value[state]
                hit = found >= 0
                if hit.any():
                    at_hit, row, number = live[hit], rows[live[hit]], found[hit]
                    single[at_hit[step[at_hit] == j + 1 - at]] = True
                    score = best[row, at] + scores[number]
                    better = score > best[row, j + 1]
                    row = row[better]
                    best[row, j + 1], start[row, j + 1], piece[row, j + 1] = score[better], at, number[better]
            lone = np.flatnonzero(~single)
            if len(lone):
                row, end = rows[lone], at + step[lone]
                score = best[row, at] + self.unknown
                better = score > best[row, end]
                row, end = row[better], end[better]
                best[row, end], start[row, end], piece[row, end] = score[better], at, -1
                if self.fallback:  # one step for each byte of the character
                    for k in range(4):
                        inner = end - k
                        go = inner > at
                        piece[row[go], inner[go]], start[row[go], inner[go]] = -1, inner[go] - 1
        out = np.zeros((n, width), np.int32)
        count, place = np.zeros(n, np.int64), sizes.copy()
        rows = np.flatnonzero(place > 0)
        while len(rows):
            end = place[rows]
            got = piece[rows, end]
            other = self.bytes[letters[rows, end - 1]] if self.fallback else np.int32(self.unknown_id)
            out[rows, count[rows]] = np.where(got >= 0, got, other)
            count[rows] += 1
            place[rows] = start[rows, end]
            rows = rows[place[rows] > 0]
        # Found from the end; turn every row round.
        return [out[i, c - 1 :: -1].tobytes() if c else b"" for i, c in enumerate(count.tolist())]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct marked words, remembered."""
        out = list(map(self.known.get, words))
        new = [i for i, x in enumerate(out) if x is None]
        if new:
            if len(self.known) > KEPT_WORDS:
                self.known = {}
            raw = {i: words[i].encode() for i in new}
            short = sorted((i for i in new if len(raw[i]) <= GROUP_BYTES), key=lambda i: len(raw[i]))
            for k in range(0, len(short), GROUP_WORDS):
                group = short[k : k + GROUP_WORDS]
                for i, ids in zip(group, self.search_many([raw[i] for i in group])):
                    out[i] = self.known[words[i]] = ids
            for i in new:
                if out[i] is None:
                    out[i] = np.array(self.search(raw[i]), np.int32).tobytes()
        return out

    def marked_words(self, text: str) -> list[str]:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return []
        text = (" " if self.add_prefix else "") + text
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text.replace(" ", MARK))

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as an Arrow list; a null text has none."""
        texts = texts.fill_null("")
        plain = ~pc.match_substring_regex(texts, f"  |^ |^$|{MARK}").to_numpy(zero_copy_only=False)
        if self.squeeze or not self.add_prefix:
            plain[:] = False
        words, owner = [], []
        fast = np.flatnonzero(plain)
        if len(fast):
            parts = pc.split_pattern(texts.take(pa.array(fast)), " ")
            coded = parts.flatten().dictionary_encode()
            words = [MARK + w for w in coded.dictionary.to_pylist()]
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(fast, np.diff(parts.offsets.to_numpy()))
        else:
            codes, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        more: dict[str, int] = {}
        extra, extra_owner = [], []
        for i in np.flatnonzero(~plain).tolist():
            for word in self.marked_words(texts[i].as_py()):
                extra.append(more.setdefault(word, len(words) + len(more)))
                extra_owner.append(i)
        codes = np.concatenate([codes, np.array(extra, np.int64)])
        owner = np.concatenate([owner, np.array(extra_owner, np.int64)])
        order = np.argsort(owner, kind="stable")
        codes, owner = codes[order], owner[order]
        ids = self.ids_of([*words, *more])
        sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), np.int32)
        begin = np.cumsum(sizes) - sizes
        n = sizes[codes]
        at = np.repeat(begin[codes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        per_text = np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[at]))

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.add_prefix and text.startswith(" ") else text

    def decode_many(self, lists: pa.Array) -> pa.Array:
        """``decode`` of every list: one gather over a pool of all pieces' bytes a block.

        Blocks hold lists of at most ``DECODE_IDS`` ids (one list at least), so memory
        stays bounded however long the texts and batches are. Lists whose bytes are not valid
        UTF-8 (ids no encoding gives) are decoded one by one with replacement characters.
        Null lists give null.
        """
        if not hasattr(self, "_pool"):
            sizes = np.fromiter((len(x) for x in self.raw), np.int64, len(self.raw))
            self._pool = (np.frombuffer(b"".join(self.raw), np.uint8), np.cumsum(sizes) - sizes, sizes)
        lists = lists.cast(pa.list_(pa.int32()))
        # Blocks by number of ids, known from the offsets alone: no array of the whole
        # batch's ids is built.
        offsets = lists.offsets.to_numpy().astype(np.int64)
        blocks, start = [], 0
        while True:
            end = int(np.searchsorted(offsets, offsets[start] + DECODE_IDS, side="right")) - 1
            end = min(max(end, start + 1), len(lists))
            blocks.append(self._decode_block(lists.slice(start, end - start)))
            start = end
            if start >= len(lists):
                break
        return pa.concat_arrays(blocks) if len(blocks) > 1 else blocks[0]

    def _decode_block(self, lists: pa.Array) -> pa.Array:
        pool, begin, sizes = self._pool
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        n = sizes[ids]
        at = np.repeat(begin[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])[offsets - offsets[0]]
        raw = pa.BinaryArray.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(pool[at])]
        )
        try:
            text = raw.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())
        if self.add_prefix:
            text = pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text)
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), text)


#: One model per file content in each Python worker.
_models: dict[str, Model] = {}


def codec(spark, path: str):
    """Column functions ``encode(text)`` and ``decode(ids)`` for the model file at ``path``.

    The driver reads the file and builds the trie; tasks get both as a broadcast value
    of the vocabulary's fixed size.
    """
    with open(path, "rb") as file:
        content = file.read()
    shared, key = spark.sparkContext.broadcast(Model(content)), hashlib.sha1(content).hexdigest()

    def model():
        if key not in _models:
            _models[key] = shared.value
        return _models[key]

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(texts: pa.Array) -> pa.Array:
        own = model()
        parts = [own.encode(part) for part in slices_by_bytes(texts, SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        own = model()
        return own.decode_many(ids)

    return encode, decode


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids``, the pieces of each whole text; a column of that name is replaced.

    Null and empty texts have an empty list. Nothing is shuffled.
    """
    encode, _ = codec(docs.sparkSession, path)
    return docs.withColumn(ids_col, encode(F.col(text_col)))


def decode_documents(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``decoded``: byte pieces joined, markers as spaces, one leading space cut.

    Gives back the encoded text; a marker that stood in the text itself becomes a space,
    which the format cannot tell apart. Null lists stay null.
    """
    _, decode = codec(docs.sparkSession, path)
    return docs.withColumn(text_col, decode(F.col(ids_col)))
