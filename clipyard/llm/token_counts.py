"""Token counts of whole texts, by a byte-level BPE tokenizer file.

Only lengths leave the Arrow function. A text is cut where a space follows a character
that is no white space: the pre-tokenizer of byte-level BPE always ends a token there
and looks at nothing before it, and added special tokens hold no space, so the counts
of the pieces add up to the count of the text. Pieces repeat, so each distinct piece
of a batch is encoded once, in calls of about the same number of bytes, and its length
is remembered by the worker.
"""

import hashlib
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text handled at once, and bytes of one encoding call.
SLICE_BYTES = 4 << 20
CALL_BYTES = 256 << 10
#: Pieces up to this many characters are remembered, this many of them.
KEPT_CHARS = 48
KEPT_PIECES = 1_500_000

#: A space after anything that is surely no white space is a safe place to cut.
_UNSURE = r"[^\pL\pM\pN\pP\pS] "


class Counter:
    """Lengths of pieces under one tokenizer, remembered between batches."""

    def __init__(self, definition: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {"": 0}

    def _encode(self, pieces: list[str]) -> list[int]:
        out, call, size = [], [], 0
        for piece in pieces:
            call.append(piece)
            size += len(piece)
            if size >= CALL_BYTES:
                out += map(len, self.tokenizer.encode_batch_fast(call, add_special_tokens=False))
                call, size = [], 0
        if call:
            out += map(len, self.tokenizer.encode_batch_fast(call, add_special_tokens=False))
        return out

    def lengths(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece; the pieces are distinct."""
        out = list(map(self.known.get, pieces))
        new = [i for i, n in enumerate(out) if n is None]
        if new:
            if len(self.known) > KEPT_PIECES:
                self.known = {"": 0}
            missing = [pieces[i] for i in new]
            for i, piece, n in zip(new, missing, self._encode(missing)):
                out[i] = n
                if len(piece) <= KEPT_CHARS:
                    self.known[piece] = n
        return np.array(out, np.int64)

    def _of(self, words: pa.Array, prefix: str) -> np.ndarray:
        coded = words.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if not pieces:
            return np.zeros(0, np.int64)
        found = self.lengths([prefix + p for p in pieces])
        return found[coded.indices.to_numpy(zero_copy_only=False)]

    def _plain(self, texts: pa.Array) -> np.ndarray:
        """Texts in which every space may be cut at."""
        parts = pc.split_pattern(texts, " ")
        words, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
        heads = offsets[:-1] - offsets[0]
        first = np.zeros(len(words), bool)
        first[heads] = True
        counts = np.empty(len(words), np.int64)
        counts[first] = self._of(words.filter(pa.array(first)), "")
        counts[~first] = self._of(words.filter(pa.array(~first)), " ")
        return np.add.reduceat(counts, heads) if len(heads) else counts

    def _careful(self, text: str) -> int:
        """A text with white space before a space: cut at the other spaces only."""
        pieces, held = [], ""
        for k, word in enumerate(text.split(" ")):
            piece = word if k == 0 else " " + word
            # Also not sure: the start of the text, which is a cut anyway.
            if held and not held[-1].isspace() and held[-1].isprintable():
                pieces.append(held)
                held = piece
            else:
                held += piece
        pieces.append(held)
        distinct: dict[str, int] = {}
        for piece in pieces:
            distinct[piece] = distinct.get(piece, 0) + 1
        return int(self.lengths(list(distinct)) @ np.fromiter(distinct.values(), np.int64))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a null text has none."""
        texts = texts.fill_null("")
        out = np.zeros(len(texts), np.int64)
        unsure = pc.match_substring_regex(texts, _UNSURE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(unsure).tolist():
            out[i] = self._careful(texts[i].as_py())
        plain = np.flatnonzero(~unsure)
        if len(plain):
            out[plain] = self._plain(texts.take(pa.array(plain)))
        return out


#: One counter per tokenizer file in each Python worker.
_counters: dict[str, Counter] = {}


def slices_by_bytes(texts: pa.Array, size: int = SLICE_BYTES):
    """Runs of rows of about ``size`` bytes; one longer text is a run of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(at, end - at)
        at = end


def token_counter(spark, path: str):
    """A column function text -> number of tokens, for the tokenizer file at ``path``.

    The driver reads the file; tasks get it as a broadcast value of its fixed size.
    """
    with open(path, "rb") as file:
        content = file.read()
    definition, key = spark.sparkContext.broadcast(content), hashlib.sha1(content).hexdigest()

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        counter = _counters.get(key)
        if counter is None:
            counter = _counters[key] = Counter(definition.value)
        parts = [counter.count(part) for part in slices_by_bytes(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return count


def count_tokens(docs: DataFrame, path: str, max_tokens: int = 512, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``max_tokens``).

    A null or empty text has no bytes and no tokens. Special strings inside a text are
    what the library makes of them by default: one token. Columns of ``docs`` with the
    names of the result are replaced. Nothing is shuffled.
    """
    count = token_counter(docs.sparkSession, path)
    text = F.col(text_col)
    return docs.withColumns(
        {"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"), "n_tokens": count(text)}
    ).withColumn("over_limit", F.col("n_tokens") > max_tokens)
