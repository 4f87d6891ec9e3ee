"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two
of n's binary form (as many of the largest allowed length as fit, then each
smaller power at most once), largest first. A piece is a whole sequence of its
own: no sequence crosses documents and none needs padding, since a sequence
whose length is a power of two is not padded. ``bucket`` is that length; batches
are drawn from rows of one bucket.

The job is one scan without a shuffle. A sequence id is the number of the
scan's partition and a counter in it, so it is unique, and the same again when
a lost task is run again.

Defined results: null and empty texts are one piece holding the end id alone;
repeated rows and repeated ids are packed each on its own; null ids stay null;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import text_slices

SCHEMA = ("doc_id long, start long, length long, bucket int, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
_ENCODERS: dict[str, "PieceIds"] = {}


class PieceIds:
    """Ids of texts by a tokenizer that lower-cases and drops white space, remembered by piece.

    White space separates pre-tokens and is dropped by this kind of tokenizer, so
    the ids of a text are the ids of its blank-separated pieces one after another.
    Texts are lower-cased and a comma or full stop between a letter or digit and a
    blank is made a piece of its own before the split; neither changes the ids, and
    it makes pieces repeat. Splitting and finding the distinct pieces of a batch are Arrow kernels;
    only distinct pieces become Python objects. Texts with marks that compose with letters, special
    strings or letters whose lower case depends on their place are encoded whole.
    A new piece of Latin letters goes straight to the vocabulary's merges, any other
    through the whole tokenizer. The properties of the file that this needs are
    probed once, in ``__init__``. The cache is bounded, in two generations.
    """

    #: Characters that rule out work on pieces (combining marks, capital sigma, dotted capital I, special strings).
    WHOLE = r"[\x{02be}\x{0300}-\x{036f}\x{03a3}\x{0130}]|<\|"
    #: A comma or full stop that is not a part of a longer run of punctuation.
    MARK = r"([\p{L}\p{N}])([,.]) "

    def __init__(self, path: str, limit: int = 400_000, longest: int = 48):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: 256 + i for i, b in enumerate(rest)}  # printable stand-ins of byte-level vocabularies
        self.limit, self.longest = limit, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        probe = "Ab c\nd' s, 1 2.\n\n \u00c9e!?"
        parts = ["ab", "c", "d'", "s", ",", "1", "2", ".", "\u00e9e", "!?"]
        if self._encode([probe])[0] != b"".join(map(self._new(parts).__getitem__, parts)):
            raise ValueError(f"{path}: keeps case or white space, or joins words; pieces can't be encoded on their own")

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of lower-case pieces that aren't remembered."""
        words = [p for p in pieces if p.isalpha() and (p.isascii() or max(p) < "\u0100")]
        bare = [p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(self.alphabet) for p in words]
        found = self.merges.encode_batch_fast(bare, add_special_tokens=False)
        known = {p: array("I", x.ids).tobytes() for p, x in zip(words, found, strict=True)}
        others = [p for p in pieces if p not in known]
        known.update(zip(others, self._encode(others), strict=True))
        return known

    def _known(self, distinct: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        here = dict(zip(distinct, map(young.get, distinct), strict=True))
        again = [p for p, k in here.items() if k is None]
        kept = {p: k for p, k in zip(again, map(old.get, again), strict=True) if k is not None}
        missing = [p for p in again if p not in kept]
        for i in range(0, len(missing), 8192):
            new = self._new(missing[i:i + 8192])
            here.update(new)
            kept.update((p, k) for p, k in new.items() if len(p) <= self.longest)
        here.update(kept)
        young.update(kept)
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return list(map(here.__getitem__, distinct))

    def ids(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of an Arrow column (null: empty)."""
        column = pc.fill_null(column, "")
        whole = pc.match_substring_regex(column, self.WHOLE).to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(pc.replace_substring(column.filter(pa.array(~whole)), "\n", " "))
        split = pc.split_pattern(pc.replace_substring_regex(low, self.MARK, r"\1 \2 "), " ")
        pieces = split.flatten().dictionary_encode()
        known = self._known(pieces.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, start = np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size
        at = pieces.indices.to_numpy()
        n = size[at]
        ends = np.cumsum(n)
        every = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[at] - ends + n, n)]
        bounds = np.concatenate([[0], ends])[np.cumsum(np.concatenate([[0], pc.list_value_length(split).to_numpy()]))]
        parts = iter(np.split(every, bounds[1:-1]) if len(bounds) > 1 else ())
        return [np.frombuffer(self._encode([column[i].as_py()])[0], "<u4") if w else next(parts) for i, w in enumerate(whole)]


def piece_lengths(n: int, longest: int) -> list[int]:
    """Binary decomposition of n with no power above ``longest`` (itself a power of two), largest first."""
    out = [longest] * (n // longest)
    rest = n % longest
    while rest:
        top = 1 << (rest.bit_length() - 1)
        out.append(top)
        rest -= top
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, *, max_length: int = 4096,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, place in the document, ids, bucket and sequence."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer_path) or _ENCODERS.setdefault(tokenizer_path, PieceIds(tokenizer_path))
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in text_slices(batch, 1):
                rows: list[list] = [[] for _ in range(7)]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.ids(part.column(1)), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    total, start = len(ids) // 4, 0
                    for length in piece_lengths(total, max_length):
                        for column, value in zip(rows, (doc, start, length, total, sequence, 0,
                                                        ids[4 * start:4 * (start + length)]), strict=True):
                            column.append(value)
                        sequence += 1
                        start += length
                doc, start, length, total, seq, offset, ids = rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(total, pa.int64()), pa.array(seq, pa.int64()),
                     pa.array(offset, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "bucket", "doc_tokens", "sequence_id", "offset", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
