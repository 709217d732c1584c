"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a piece the table holds the last token of the prefix's encoding. That token is unique: of the
tokens that end there, it is the one that stands next to the last token of the prefix before it in an encoding,
that is, the pair's bytes encode to just this pair. So a piece is appended to without a look at its earlier
tokens, and an edit changes the table only near the edit.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.pieces import PieceCache
from tripmart.llm.workers import kept, task


class Vocabulary:
    """Token bytes by rank; ranks order the merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self._spines: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """A file with a line for each token: its bytes in base64, and its rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def merges(self, data: bytes, until: int = 1) -> list[bytes]:
        """BPE by its definition: merge the leftmost pair of lowest rank while more than ``until`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            if best == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts at one border of a token, outermost first: bytes, rank when made, rank when merged on."""
        if (known := self._spines.get((token, side))) is None:
            data, end = self.tokens[token], 1 << 62
            known = []
            while True:
                rank = self.ranks[data] if len(data) > 1 else -1
                known.append((data, rank, end))
                if len(data) == 1:
                    break
                data, end = self.merges(data, 2)[side], rank
            self._spines[token, side] = known
        return known

    def reachable(self, token: int) -> bool:
        """Whether the token's bytes encode to the token itself."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = len(self.merges(self.tokens[token])) == 1
        return known

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding.

        They can't if, while merges go on in the order of ranks, a part that ends the left token and one that
        begins the right token are there at the same time and merge before either merges within its own token.
        """
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = True
            for a, made_a, gone_a in self._spine(left, -1):
                for b, made_b, gone_b in self._spine(right, 0):
                    if made_a < gone_b and made_b < gone_a:
                        rank = self.ranks.get(a + b)
                        if rank is not None and rank < gone_a and rank <= gone_b:
                            known = False
            self.pairs[left, right] = known
        return known


class Prefixes:
    """A piece of bytes with the last token of each of its prefixes; ``last[i]`` ends at byte ``i``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _token_at(self, data: bytes, end: int) -> int:
        """The one token that can end here; most are short, so short ones are tried first."""
        v, last = self.vocabulary, self.last
        rank_of, pairs, whole = v.ranks.get, v.pairs.get, v.whole.get
        for start in range(end - 1, max(-1, end - v.longest - 1), -1):
            token = rank_of(data[start:end])
            if token is None:
                continue
            if start:
                fits = pairs((last[start], token))
                if fits is None:
                    fits = v.adjacent(last[start], token)
                if not fits:
                    continue
            fits = whole(token)
            if fits or fits is None and v.reachable(token):
                return token
        raise ValueError(f"no token ends at byte {end}: the vocabulary lacks single bytes")

    def append(self, data: bytes) -> None:
        """Add bytes at the end; what stands before stays as it is."""
        begin, self.data = len(self.data), self.data + data
        for end in range(begin + 1, len(self.data) + 1):
            self.last.append(self._token_at(self.data, end))

    def edit(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in the place of bytes ``start`` to ``stop``. Returns how many prefixes were worked out anew.

        A prefix's token depends on the tokens of the prefixes at most ``longest`` bytes before it, and on those
        bytes. Once so many in a row are as they were, the rest is as it was.
        """
        old, shift = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[: start + 1]
        equal = 0
        for end in range(start + 1, len(self.data) + 1):
            token = self._token_at(self.data, end)
            self.last.append(token)
            equal = equal + 1 if end > start + len(data) and old[end - shift] == token else 0
            if equal >= self.vocabulary.longest:
                self.last += old[end - shift + 1 :]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        """The encoding, read from the last prefix back."""
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[self.last[end]])
        return out[::-1]


class Encoder:
    """Encodes texts; each match of ``pattern`` is a piece of its own."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.matches = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self.pieces = PieceCache(self._joined, between=b",")
        self._bytes = {str(rank).encode(): token for token, rank in vocabulary.ranks.items()}

    def encode(self, text: str) -> list[int]:
        return [i for x in self.matches(text) for i in Prefixes(self.vocabulary, x.encode()).ids()]

    def _piece(self, piece: str) -> bytes:
        if (known := self._known.get(piece)) is None:
            if len(self._known) > 400_000:
                self._known.clear()
            ids = Prefixes(self.vocabulary, piece.encode()).ids()
            known = self._known[piece] = ",".join(map(str, ids)).encode()
        return known

    def _joined(self, texts: list[str]) -> list[bytes]:
        return [b",".join(map(self._piece, self.matches(x))) for x in texts]

    def decimal(self, text: str) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.pieces.of(text)

    def decode(self, decimal: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, decimal.split(b","))) if decimal else b""


@kept(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, so that its pieces serve all tasks there."""
    return Encoder(Vocabulary.from_file(path), pattern)


def round_trip(df: DataFrame, path: str, pattern: str, whole: bool = True) -> DataFrame:
    """Encode every text of ``df`` (doc_id, text) and decode the ids: doc_id, n_tokens, ids_sha256, decoded_sha256,
    and, if ``whole``, ids (decimal, by commas) and decoded (bytes).

    A null text is empty: no ids, and the hashes of nothing. A row for each input row, repeated ones and null ids
    too; other columns are left out.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = []
                for ids in bpe.pieces.of_many([x or "" for x in part.column(1).to_pylist()]):
                    decoded = bpe.decode(ids)
                    row = ids.count(b",") + bool(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
                    rows.append(row + (ids.decode(), decoded) * whole)
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * whole
    types = [pa.int64(), pa.string(), pa.string()] + [pa.string(), pa.binary()] * whole
    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded binary" * whole
    return df.select(df["doc_id"], df["text"]).mapInArrow(task(encode, encoder), schema)
