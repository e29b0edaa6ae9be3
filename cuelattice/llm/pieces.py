"""SentencePiece encoding and decoding by batched Viterbi.

Texts are cut into units (`units`) wherever two adjacent bytes stand side by side in
no piece, word boundaries above all; distinct units are encoded once per worker, all
units of one length together: a table holds, per end position, the best last piece
and where it starts. Substrings are found by probing the sorted hashes of the pieces;
a bit table leaves out most of those that are no piece.

* Unigram models: the best path has the largest sum of piece scores.
* Merge (BPE) models: the largest sum of scores is not what the merges produce, so
  a transition is allowed only if the merges would leave the two pieces side by
  side; then exactly one path is left and it is the library's result.

Characters without a piece become byte pieces, or the unknown piece if the model
has none. Decoding joins pieces and bytes; bytes that are no UTF-8 become U+FFFD.
Models are loaded from a path, never trained.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units as U
from .common import held, mix64, text_views

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
CACHE = 150_000
#: Bytes of text that are encoded at once.
BLOCK = 1_000_000
MEMO, SIEVE = 20, 22
_NEVER = np.int64(1 << 40)


def _prefix(codes: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes along the last axis; substrings come by difference."""
    out = np.zeros((*codes.shape[:-1], codes.shape[-1] + 1), np.uint64)
    for k in range(codes.shape[-1]):
        out[..., k + 1] = out[..., k] * _BASE + codes[..., k]
    return out


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def model_type(proto: bytes) -> int:
    """trainer_spec.model_type of a model file: 1 unigram (the default), 2 merges."""

    def fields(data: bytes):
        at = 0

        def varint():
            nonlocal at
            value = shift = 0
            while True:
                b = data[at]
                at += 1
                value |= (b & 127) << shift
                shift += 7
                if b < 128:
                    return value

        while at < len(data):
            tag = varint()
            if tag & 7 == 0:
                yield tag >> 3, varint()
            elif tag & 7 == 2:
                size = varint()
                yield tag >> 3, data[at : at + size]
                at += size
            else:
                at += 4 if tag & 7 == 5 else 8

    spec = next((v for k, v in fields(proto) if k == 2), b"")
    return next((v for k, v in fields(spec) if k == 3), 1)


class Pieces:
    """Pieces of a model, and Viterbi over batches of equally long units."""

    def __init__(self, model_file: str | None = None, model_proto: bytes | None = None):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file) if model_file else SentencePieceProcessor(model_proto=model_proto)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        kind = ["b" if sp.is_byte(i) else "x" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "p" for i in range(n)]
        self.unk = sp.unk_id()
        self.bytes = {int(t[3:5], 16): i for i, t in enumerate(self.text) if kind[i] == "b"}
        self.raw = [bytes([int(t[3:5], 16)]) if k == "b" else b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else t.replace(SPACE, " ").encode() for i, (t, k) in enumerate(zip(self.text, kind, strict=True))]
        self.score = np.array([sp.get_score(i) for i in range(n)], np.float32)
        self.own = {t: i for i, (t, k) in enumerate(zip(self.text, kind, strict=True)) if k == "p"}
        self.merges = model_type(sp.serialized_model_proto()) == 2
        if any(re.search(rf"[^{SPACE}]{SPACE}", t) for t in self.own):
            raise ValueError("a piece spans a word boundary")
        self.dummy = sp.encode("a", out_type=str)[0].startswith(SPACE)
        if sp.encode("A  béﬁ ", out_type=str) and "".join(sp.encode("A  b ", out_type=str)) != (SPACE if self.dummy else "") + f"A{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models that leave the text as it is can be used")
        self.apart = self._apart_bytes()
        self.longest = max(map(len, self.own))
        usable = self._split() if self.merges else list(self.own.values())
        self.pow = _powers(4096)
        keys = np.array([self._hash(self.text[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(usable)[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[self.keys >> np.uint64(64 - SIEVE)] = True
        self.memo_key, self.memo = np.full(1 << MEMO, -1, np.int64), np.zeros(1 << MEMO, bool)
        self.raw_size = np.array([len(x) for x in self.raw])
        self.raw_first, self.raw_bytes = np.cumsum(self.raw_size) - self.raw_size, np.frombuffer(b"".join(self.raw), np.uint8)
        self.cache = U.UnitTable(self._learn, CACHE, np.int32)

    def _apart_bytes(self) -> np.ndarray:
        """Pairs of bytes that a unit may end between: no piece has them side by side.
        Characters beyond ASCII stay together, and with what no space parts from them."""
        apart = np.ones((256, 256), bool)
        for t in self.own:
            b = t.replace(SPACE, " ").encode()
            apart[list(b[:-1]), list(b[1:])] = False
        apart[128:], apart[:, 128:] = False, False
        apart[:, 32], apart[32, 32] = True, False
        if not self.bytes:  # unknown characters in a row become one unknown piece
            known = np.zeros(256, bool)
            known[[ord(t.replace(SPACE, " ")) for t in self.own if len(t) == 1 and (t == SPACE or t.isascii())]] = True
            apart &= known[:, None] | known[None, :]
        return apart.ravel()

    def _hash(self, t: str) -> np.uint64:
        return mix64(_prefix(np.array([[ord(c) for c in t]], np.uint64))[0, -1:] ^ np.uint64(len(t)))[0]

    def _split(self) -> list[int]:
        """Last merge of each piece, as left and right part; rank of every mergeable
        pair. Pieces that their own merges do not produce are left out."""
        rank = {t: int(-self.score[i]) for t, i in self.own.items()}
        n = len(self.text)
        self.rank, self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1), np.full(n + 1, -1)
        usable = []
        for t, i in self.own.items():
            parts = list(t)
            while len(parts) > 2:
                best = min((rank.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best[0] == _NEVER:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            if len(parts) == 2 and all(p in self.own for p in parts):
                self.rank[i], self.left[i], self.right[i] = rank[t], self.own[parts[0]], self.own[parts[1]]
            if len(parts) == 1 or self.rank[i] >= 0:
                usable.append(i)
        good = set(usable)
        pairs = [(self.own[t[:k]] * (n + 1) + self.own[t[k:]], rank[t]) for t, i in self.own.items() if i in good for k in range(1, len(t)) if self.own.get(t[:k]) in good and self.own.get(t[k:]) in good]
        pairs.sort()
        self.pair, self.pair_rank = np.array([p for p, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64)
        return usable

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces a and b apart. From the whole pieces back
        to their characters, the part made last is undone; two parts that meet at
        the seam would be merged if their pair ranks before the merge that used
        either up (at equal rank the left one goes first)."""
        n = len(self.text)
        out = np.ones(len(a), bool)
        at = np.flatnonzero((a < n) & (b < n))
        x, y = a[at], b[at]
        dx, dy = np.full(len(at), _NEVER), np.full(len(at), _NEVER)
        while len(at):
            key = x * (n + 1) + y
            k = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            r = np.where(self.pair[k] == key, self.pair_rank[k], _NEVER)
            joined = (r < dx) & (r <= dy)
            out[at[joined]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~joined & (np.maximum(rx, ry) >= 0)
            at, x, y, dx, dy, rx, ry = (v[go] for v in (at, x, y, dx, dy, rx, ry))
            undo = rx > ry
            dx, dy = np.where(undo, rx, dx), np.where(undo, dy, ry)
            x, y = np.where(undo, self.right[x], x), np.where(undo, y, self.left[y])
        return out

    def viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces of each of some units of one length, and all their ids in a
        row; id len(text) marks a character that has no piece."""
        n, size = len(units), len(units[0])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, size).astype(np.uint64)
        pre = _prefix(codes)
        if size >= len(self.pow):
            self.pow = _powers(2 * size)
        none = len(self.text)
        best = np.full((n, size + 1), -np.inf, np.float32)
        best[:, 0] = 0
        last, back = np.full((n, size + 1), none), np.zeros((n, size + 1), np.int64)
        floor = self.score.min() - np.float32(10)
        for end in range(1, size + 1):
            for length in range(min(end, self.longest), 0, -1):  # ties to the longer last piece
                start = end - length
                h = mix64((pre[:, end] - pre[:, start] * self.pow[length]) ^ np.uint64(length))
                if length == 1:
                    ok = np.arange(n)
                    piece = self._probe(h)
                else:
                    ok = np.flatnonzero(self.sieve[h >> np.uint64(64 - SIEVE)])
                    piece = self._probe(h[ok])
                    ok, piece = ok[piece != none], piece[piece != none]
                if not len(ok):
                    continue
                if self.merges:
                    if start:
                        apart = self._apart(last[ok, start], piece)
                        ok, piece = ok[apart], piece[apart]
                    value = best[ok, start] + np.float32(1)
                else:
                    value = best[ok, start] + np.where(piece == none, floor, self.score[np.minimum(piece, none - 1)])
                up = value > best[ok, end]
                ok, piece = ok[up], piece[up]
                best[ok, end], last[ok, end], back[ok, end] = value[up], piece, start
        out, used = np.full((n, size), -1, np.int32), np.zeros(n, np.int64)
        at, rows = np.full(n, size), np.arange(n)
        while len(rows):  # from the last piece to the first, written from the right
            used[rows] += 1
            out[rows, size - used[rows]] = last[rows, at[rows]]
            at[rows] = back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return used, out[out >= 0]

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, len(text) if there is none."""
        k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[k] == h, self.key_ids[k], len(self.text))

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """side_by_side, with the pairs decided last kept in a table."""
        key = a * (len(self.text) + 1) + b
        slot = (key.astype(np.uint64) * _BASE) >> np.uint64(64 - MEMO)
        out, miss = self.memo[slot], np.flatnonzero(self.memo_key[slot] != key)
        if len(miss):
            new, inverse = np.unique(key[miss], return_inverse=True)
            found = self.side_by_side(new // (len(self.text) + 1), new % (len(self.text) + 1))
            out[miss] = found[inverse]
            at = (new.astype(np.uint64) * _BASE) >> np.uint64(64 - MEMO)
            at, one = np.unique(at, return_index=True)
            self.memo_key[at], self.memo[at] = new[one], found[one]
        return out

    def _learn(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = [u.decode().replace(" ", SPACE) for u in units]
        length = np.array([len(t) for t in text])
        order = np.argsort(length, kind="stable")
        none, who, sizes, flat = len(self.text), [], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        ends = np.r_[np.flatnonzero(np.diff(length[order])) + 1, len(order)] if len(order) else []
        lo = 0
        for hi in np.asarray(ends, np.int64).tolist():
            step = max(1, 400_000 // (int(length[order[lo]]) + 1))
            for k in range(lo, hi, step):
                some = order[k : min(k + step, hi)]
                size, ids = self.viterbi([text[i] for i in some.tolist()])
                bad = np.zeros(len(some), bool)
                bad[np.repeat(np.arange(len(some)), size)[ids == none]] = True
                if bad.any():
                    first = np.cumsum(size) - size
                    for r in np.flatnonzero(bad).tolist():
                        own = self._fallback(text[some[r]], ids[first[r] : first[r] + size[r]].tolist())
                        who.append(some[r : r + 1])
                        sizes.append(np.array([len(own)]))
                        flat.append(np.array(own, np.int32))
                    ids = ids[~np.repeat(bad, size)]
                who.append(some[~bad])
                sizes.append(size[~bad])
                flat.append(ids)
            lo = hi
        back = np.argsort(np.concatenate([order[:0], *who]), kind="stable")
        size, ids = np.concatenate(sizes), np.concatenate(flat)
        return size[back], U.gather(ids, (np.cumsum(size) - size)[back], size[back])

    def _fallback(self, unit: str, ids: list[int]) -> list[int]:
        out, at = [], 0
        for i in ids:
            if i < len(self.text):
                out.append(i)
                at += len(self.text[i])
                continue
            if self.bytes:
                out += [self.bytes[b] for b in unit[at].encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
            at += 1
        return out

    def blocks(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, ids, ends): the ids of texts lo to hi in a row, and where each
        text's end; as the library's encode() gives them."""
        for lo, hi, data, ends in U.blocks(texts, b" " if self.dummy else b"", BLOCK):
            ids, upto = self.cache.encode(data, *U.cut(data, ends, self.apart))
            yield lo, hi, ids, upto

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        return [ids[s:e] for _, _, ids, upto in self.blocks([t.encode() for t in texts]) for s, e in zip([0, *upto[:-1].tolist()], upto.tolist(), strict=True)]

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each text of a block of ids, without the space put before it."""
        size = self.raw_size[ids]
        data, upto = U.gather(self.raw_bytes, self.raw_first[ids], size).tobytes(), np.r_[0, np.cumsum(size)][ends].tolist()
        lead = 1 if self.dummy else 0
        return [data[s + (lead and data[s : s + 1] == b" ") : e] for s, e in zip([0, *upto[:-1]], upto, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """One model for all tasks of a Python worker."""
    return held(("pieces", path), lambda: Pieces(path))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [bytes(v or b"") for v in text_views(batch)]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) for every row of (doc_id, text). Null and
    empty texts have no ids; rows may repeat; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for lo, hi, ids, ends in model.blocks(_texts(batch)):
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(ends, prepend=0)), lists], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode_documents(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text for every row of (doc_id, ids); null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            text = [model.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest_round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), round_trip (whether decoding gives the text back), for every row
    of (doc_id, text). Null and empty texts have no ids and come back; rows may repeat;
    an empty table gives an empty result; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            texts = _texts(batch)
            for lo, hi, ids, ends in model.blocks(texts):
                some, back, raw, at = texts[lo:hi], model.decoded(ids, ends), ids.astype("<u4"), [0, *ends.tolist()]
                crc = [zlib.crc32(raw[s:e]) for s, e in zip(at, at[1:], strict=False)]
                same = [t == b or t.decode() == b.decode("utf-8", "replace") for t, b in zip(some, back, strict=True)]
                chars = pa.compute.utf8_length(batch.column(1).slice(lo, hi - lo)).fill_null(0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), chars, pa.array(np.diff(ends, prepend=0)), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_chars", "n_tokens", "ids_crc32", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_chars long, n_tokens long, ids_crc32 long, round_trip boolean")
