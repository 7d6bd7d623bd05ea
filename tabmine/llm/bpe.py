"""Operator 6: byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has one encoding, so one last token.  A sequence
is the encoding exactly when every neighbouring pair of tokens is the encoding
of its own bytes.  The table therefore keeps, per prefix, its only valid last token: a
token that ends there and is compatible with the last token of the prefix
before it.  Appending extends the table; an edit recomputes it from the edit on, until the
old entries hold again."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import mix64, text_slices

_BASE = 0x9E3779B97F4A7C15 | 1
_LONG = 64


def load_ranks(path: str) -> list[bytes]:
    """Token bytes in id order from a file of ``base64 id`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(i): base64.b64decode(b) for b, i in pairs}
    return [ranks[i] for i in range(len(ranks))]


class PrefixCoder:
    """Encoder over a rank-ordered vocabulary that holds all single bytes."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.lengths = np.array([len(t) for t in tokens])
        self.longest = int(self.lengths.max())
        # how a token is made: the two parts of its last merge (itself for bytes, none if no merges lead to it)
        self.made: list[tuple[int, int] | None] = []
        for i, t in enumerate(tokens):
            parts = self._merge(t, i) if len(t) > 1 else [i, i]
            self.made.append((parts[0], parts[1]) if len(parts) == 2 else None)
        self.usable = np.array([m is not None for m in self.made])
        self.fits: dict[int, bool] = {}
        ids = np.flatnonzero(self.usable & (self.lengths <= _LONG))
        hashes = np.array([self._hash(tokens[i]) for i in ids], dtype=np.uint64)
        order = np.argsort(hashes)
        self.table, self.table_ids = hashes[order], ids[order]
        self.widths = np.array(sorted({len(tokens[i]) for i in ids}))
        self.memo: dict[str, bytes] = {}

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Plain merging with the ranks smaller than ``below`` (used to prepare the vocabulary)."""
        parts = [data[k:k + 1] for k in range(len(data))]
        while len(parts) > 1:
            r, k = min((self.rank.get(parts[k] + parts[k + 1], below), k) for k in range(len(parts) - 1))
            if r >= below:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.rank[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        """Is ``[a, b]`` the encoding of its bytes?  The merges at the seam are undone, the
        latest first; a merge across the seam that would have come earlier rules the pair out."""
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            left, right, until = a, b, len(self.tokens)
            while True:
                across = self.rank.get(self.tokens[left] + self.tokens[right])
                if across is not None and across < until:
                    known = False
                    break
                part_l, part_r = self.made[left], self.made[right]
                can_l, can_r = part_l[1] != left, part_r[0] != right
                if not can_l and not can_r:
                    known = True
                    break
                if can_l and (left > right or not can_r):
                    until, left = left, part_l[1]
                else:                                   # of equal ranks the left one is merged first
                    until, right = right + 1, part_r[0]
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            self.fits[key] = known
        return known

    # ---- one string -----------------------------------------------------------------------------

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Append entries to ``last`` (``last[i]``: last token of ``data[:i]``; ``last[0]`` is -1)."""
        for i in range(len(last), upto + 1):
            for width in self.widths:
                if width > i:
                    break
                t = self.rank.get(data[i - width:i])
                if t is not None and self.made[t] is not None:
                    before = last[i - width]
                    if before < 0 or self.compatible(before, t):
                        last.append(t)
                        break

    def read(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= len(self.tokens[last[end]])
        return out[::-1]

    # ---- many distinct pieces at once -----------------------------------------------------------

    @staticmethod
    def _hash(data: bytes) -> np.uint64:
        h = 0
        for c in data:
            h = (h * _BASE + c + 1) % 2**64
        return mix64(np.array([h + len(data)], dtype=np.uint64) if h + len(data) < 2**64
                     else np.array([(h + len(data)) % 2**64], dtype=np.uint64))[0]

    def encode_many(self, pieces: list[bytes]) -> list[list[int]]:
        """Encodings of distinct byte strings; all short ones move through the table in step."""
        out: list[list[int] | None] = [None] * len(pieces)
        short = []
        for k, p in enumerate(pieces):
            whole = self.rank.get(p)
            if whole is not None:                       # a piece that is a token is that token
                out[k] = [whole]
            elif len(p) > _LONG:
                last = [-1]
                self.extend(p, last, len(p))
                out[k] = self.read(last, len(p))
            else:
                short.append(k)
        short.sort(key=lambda k: -len(pieces[k]))
        if short:
            size = np.array([len(pieces[k]) for k in short])
            top = int(size[0])
            chars = np.zeros((len(short), top), dtype=np.uint64)
            for r, k in enumerate(short):
                chars[r, :size[r]] = np.frombuffer(pieces[k], dtype=np.uint8)
            last = np.full((len(short), top + 1), -1, dtype=np.int64)
            for i in range(1, top + 1):
                live = int(np.searchsorted(-size, -i, side="right"))   # rows of at least i bytes come first
                widths = [w for w in range(1, min(i, self.longest) + 1)]
                h = np.zeros(live, dtype=np.uint64)
                power = np.uint64(1)
                done = np.zeros(live, dtype=bool)
                for w in widths:
                    with np.errstate(over="ignore"):
                        h = h + (chars[:live, i - w] + np.uint64(1)) * power
                        power = power * np.uint64(_BASE)
                        key = mix64(h + np.uint64(w))
                    at = np.minimum(np.searchsorted(self.table, key), len(self.table) - 1)
                    hit = np.flatnonzero((self.table[at] == key) & ~done)
                    if not len(hit):
                        continue
                    t, before = self.table_ids[at[hit]], last[hit, i - w]
                    pair, inv = np.unique((before + 1) << 32 | t, return_inverse=True)
                    ok = np.array([p >> 32 == 0 or self.compatible((p >> 32) - 1, p & 0xFFFFFFFF) for p in pair.tolist()])
                    good = hit[ok[inv]]
                    last[good, i] = t[ok[inv]]
                    done[good] = True
                    if done.all():
                        break
            rows = last.tolist()
            for r, k in enumerate(short):
                out[k] = self.read(rows[r], len(pieces[k]))
        return out

    def encode_pieces(self, texts: list[list[str]], keep: int = 300_000) -> list[bytes]:
        """Ids of each text's pieces as little-endian 32-bit numbers."""
        memo = self.memo
        if len(memo) > keep:
            memo.clear()
        new = list({p for pieces in texts for p in pieces if p not in memo})
        for p, ids in zip(new, self.encode_many([p.encode("utf-8", "replace") for p in new]), strict=True):
            memo[p] = np.array(ids, dtype="<u4").tobytes()
        return [b"".join([memo[p] for p in pieces]) for pieces in texts]

    def decode(self, ids: bytes) -> bytes:
        """Bytes behind little-endian 32-bit ids."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


class PrefixTable:
    """Encoding of one byte string that can be appended to and edited."""

    def __init__(self, coder: PrefixCoder, data: bytes = b""):
        self.coder, self.data, self.last = coder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.coder.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:end]``; entries recomputed are returned as a count.
        An entry depends on the bytes and entries one longest token back, so the old
        entries hold again once that many in a row agree."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start + 1]
        same = 0
        while len(self.last) <= len(self.data):
            i = len(self.last)
            self.coder.extend(self.data, self.last, i)
            beyond = i - start - len(new)
            same = same + 1 if beyond > 0 and old[i - shift] == self.last[i] else 0
            if same > self.coder.longest:
                done = i - start
                self.last += old[i - shift + 1:]
                return done
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.coder.read(self.last, len(self.data))


_CODERS: dict[str, PrefixCoder] = {}


def coder(tokens: list[bytes]) -> PrefixCoder:
    """One coder per vocabulary and worker process."""
    key = hashlib.md5(b"\0".join(tokens)).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = PrefixCoder(tokens)
    return _CODERS[key]


def _encoded(batches, tokens: list[bytes], pattern: str):
    """``(ids of rows, encoded ids, decoded bytes)`` of runs of rows."""
    import regex

    find, bpe = regex.compile(pattern).findall, coder(tokens)
    for batch in batches:
        at = 0
        for part in text_slices(batch.column("_text")):
            ids = bpe.encode_pieces([find(t) if t else [] for t in part])
            yield batch.column("_id").slice(at, len(part)), ids, [bpe.decode(b) for b in ids]
            at += len(part)


def _rows(docs: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows, rows.schema["_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                     id_col: str = "doc_id") -> DataFrame:
    """``(id, ids array<int>, decoded binary)`` per row: the ids of the whole text, every match
    of ``pattern`` on its own, and the bytes that they decode to.  The vocabulary
    is read once by the driver and sent along.  Null and empty texts have no ids; repeated
    rows and null ids are kept; other columns are ignored."""
    tokens = load_ranks(ranks_path)
    rows, kind = _rows(docs, text_col, id_col)

    def run(batches):
        for key, ids, decoded in _encoded(batches, tokens, pattern):
            cuts = np.concatenate([[0], np.cumsum([len(b) // 4 for b in ids])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(pa.array(cuts), values),
                                              pa.array(decoded, pa.binary())], names=["_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"_id {kind}, ids array<int>, decoded binary").withColumnRenamed("_id", id_col)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: digests of what ``encode_documents``
    returns, taken in the same task, so the ids need not travel."""
    tokens = load_ranks(ranks_path)
    rows, kind = _rows(docs, text_col, id_col)

    def run(batches):
        for key, ids, decoded in _encoded(batches, tokens, pattern):
            yield pa.RecordBatch.from_arrays(
                [key, pa.array([len(b) // 4 for b in ids], pa.int64()),
                 *[pa.array([hashlib.sha256(b).hexdigest() for b in col]) for col in (ids, decoded)]],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = rows.mapInArrow(run, f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("_id", id_col)
