"""Token counts by heap-and-linked-list byte-pair merging.

The bytes of a pre-token form a linked list; a heap holds the ranked adjacent
pairs. The lowest-rank (then leftmost) live pair is popped and merged until no
ranked pair is left. The count is the number of initial symbols less the number of
merges: no identifier is ever looked up or emitted.

A chunk that starts at a blank or newline after a non-white character is cut into
pre-tokens the same way alone as inside its text, so counts are remembered per
chunk and per pre-token (two bounded caches per worker).

Defined results: null and empty texts count 0 bytes and 0 tokens; repeated rows
are counted each; null ids stay null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import Memo, slices, texts

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Unicode white space, and the pre-token pattern of byte-level vocabularies.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
            rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_NOT_CLEAN = 1 << 50
_COUNTERS: dict[str, "TokenCounter"] = {}


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others for the code points from 256 up, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Counts of a byte-level vocabulary file (its merges and its special strings)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_alphabet()
        to_bytes = lambda s: bytes(of[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PRETOKEN)
        self.white = regex.compile(f"[{WHITE}]")
        self.single = [bytes([b]) for b in range(256)]
        self.pretokens = Memo(self.count_pretoken, limit=100_000)
        self.chunks = Memo(self._chunk, limit=250_000)

    def count_pretoken(self, pretoken: str) -> int:
        single, ranks = self.single, self.ranks
        symbol: list[bytes | None] = [single[b] for b in pretoken.encode("utf-8")]
        n = len(symbol)
        merges = 0
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get((symbol[i], symbol[i + 1]))
            if rank is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            left = symbol[i]
            j = after[i]
            if left is None or j >= n or ranks.get((left, symbol[j])) != rank:
                continue  # the pair has changed since it was pushed
            joined = left + symbol[j]
            symbol[i], symbol[j] = joined, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((joined, symbol[k]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i))
            h = before[i]
            if h >= 0:
                rank = ranks.get((symbol[h], joined))
                if rank is not None:
                    heapq.heappush(heap, (rank, h))
        return n - merges

    def _plain(self, text: str) -> int:
        return sum(map(self.pretokens.__getitem__, self.pattern.findall(text)))

    def _chunk(self, piece: str) -> int:
        """Count of a blank and ``piece``, or of ``piece`` alone if it starts with the newline that cut it."""
        core = piece[1:] if piece.startswith("\n") else piece
        if not core or self.white.match(core) or self.white.match(core, len(core) - 1):
            return _NOT_CLEAN
        return self._plain(piece if piece.startswith("\n") else " " + piece)

    def _segment(self, text: str) -> int:
        if not text:
            return 0
        pieces = text.replace("\n", " \n").split(" ")
        first = pieces[0]
        if first and not self.white.match(first, len(first) - 1):
            total = self._plain(first) + sum(map(self.chunks.__getitem__, pieces[1:]))
            if total < _NOT_CLEAN:
                return total
        return self._plain(text)  # runs of white space: cut the whole segment

    def count(self, text: str) -> int:
        self.chunks.turn()
        self.pretokens.turn()
        if self.special is None:
            return self._segment(text)
        segments = self.special.split(text)
        return sum(map(self._segment, segments)) + len(segments) - 1


def token_counts(docs: DataFrame, vocabulary_path: str, *, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each whole text; ``over_limit`` is true above ``limit`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(vocabulary_path) or _COUNTERS.setdefault(vocabulary_path, TokenCounter(vocabulary_path))
        for batch in batches:
            for part in slices(batch):
                whole = texts(part.column(1))
                counts = [counter.count(t) for t in whole]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([len(t.encode("utf-8")) for t in whole], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
