"""Token ids in flat binary files.

Layout of one file set, `<name>.bin`, `<name>.off`, `<name>.doc`:
* .bin  the ids of all its documents, one after another, little-endian unsigned
        16-bit integers where the vocabulary fits, else 32-bit;
* .off  n+1 little-endian signed 64-bit offsets, in ids, from the file's start;
* .doc  n little-endian signed 64-bit document ids, then n bytes, 1 for a null id.
File sets follow one another in ascending bucket; the base of each in the whole
corpus is the prefix sum of the sizes of those before it.

Each task attempt writes files under its own random name and returns the name;
the list of names is checkpointed, so a lost executor or a repeated attempt can
leave an unlisted file but never change what is read.
"""

from __future__ import annotations

import os
import string
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import units as U
from .common import MAX_BUCKETS, bucket_of, held, partitions, shared_dir, split_points

CACHE = 500_000
FLUSH = 8_000_000
JOIN = 100
WHITE = b" \t\n\r\x0b\x0c"
#: Strings whose ids show whether a tokenizer can be used by parts.
PROBES = ["Some Words, and more.words\n\there;  it's (3,5) A.b\x0b c", "\u00c9t\u00e9 e\u0301t\u00e9, \u0391\u03a3 \u65e5\u672c.\u8a9e x.\u0301y 12.5a", "<|STARTOFTEXT|> a , b . c"]


class CachedEncoder:
    """Ids of a text from the ids of its parts (`units`), with the tokenizers library.

    For tokenizers that lower case, drop white space and split letters from
    punctuation, which is tried at the start: a part ends before white space, and
    between an ASCII letter and a full stop or comma. Parts not met before go through
    the library together."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.vocab <= 65_536 else "<u4"
        self.last = np.zeros(1 << 8 * int(self.dtype[-1]) if self.dtype == "<u2" else self.vocab, bool)
        self.last[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        self.table = U.UnitTable(self._learn, CACHE, np.dtype(self.dtype))
        white, letter, stop = (np.isin(np.arange(256), list(x)) for x in (WHITE, string.ascii_letters.encode(), b".,"))
        self.apart = ((white[None, :] & ~white[:, None]) | (letter[:, None] & stop[None, :]) | (stop[:, None] & letter[None, :])).ravel()
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        for probe in PROBES:
            if self.encode([probe], None)[0] != np.array(self._whole([probe])[0], self.dtype).tobytes():
                raise ValueError("a tokenizer that doesn't lower case, drop white space and split punctuation can't be used by parts")

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units of letters only are one word each: JOIN of them go through the library
        as one text, and a word's last id, marked as such in the vocabulary, parts them."""
        text = [u.decode().strip() for u in units]
        word = np.array([t.isalpha() for t in text], bool)
        who, size, ids = [], [np.zeros(0, np.int64)], [np.zeros(0, self.dtype)]

        def apart(at: list[int]) -> None:
            got = self._whole([text[i] for i in at])
            who.append(at)
            size.append(np.array([len(x) for x in got], np.int64))
            ids.append(np.fromiter(chain.from_iterable(got), self.dtype))

        words, rest = np.flatnonzero(word).tolist(), np.flatnonzero(~word).tolist()
        for lo in range(0, len(words), 100 * JOIN):
            some = words[lo : lo + 100 * JOIN]
            got = self._whole([" ".join(text[i] for i in some[k : k + JOIN]) for k in range(0, len(some), JOIN)])
            flat = np.fromiter(chain.from_iterable(got), self.dtype)
            ends = np.flatnonzero(self.last[flat])
            if len(ends) != len(some):
                apart(some)
                continue
            who.append(some)
            size.append(np.diff(ends, prepend=-1))
            ids.append(flat)
        for lo in range(0, len(rest), 10_000):
            apart(rest[lo : lo + 10_000])
        back = np.argsort(np.array(list(chain.from_iterable(who)), np.int64), kind="stable")
        n, flat = np.concatenate(size), np.concatenate(ids)
        return n[back], U.gather(flat, (np.cumsum(n) - n)[back], n[back])

    def encode(self, texts: list[str], end: int | None) -> list[bytes]:
        """Ids of each text as little-endian bytes of self.dtype."""
        tail, width, out = b"" if end is None else np.array([end], dtype=self.dtype).tobytes(), int(self.dtype[-1]), []
        for _, _, data, ends in U.blocks([t.encode() for t in texts], b""):
            if b"<|" not in data.tobytes():  # else capitals may keep a special token's string from being one
                data = self.lower[data]
            ids, upto = self.table.encode(data, *U.cut(data, ends, self.apart))
            raw, at = ids.tobytes(), (np.r_[0, upto] * width).tolist()
            out += [raw[s:e] + tail for s, e in zip(at, at[1:], strict=False)]
        return out


def encoder(path: str) -> CachedEncoder:
    """One encoder for all tasks of a Python worker."""
    return held(("tokens", path), lambda: CachedEncoder(path))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    with fs.open_output_stream(path) as f:
        f.write(data)


def writer(folder: str, make: Callable[[], CachedEncoder], end: int | None) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, (fs, base) = make(), open_fs(folder)
        dtype, width = enc.dtype, int(enc.dtype[-1])
        state: dict = {}

        def close():
            name = state["name"]
            state["bin"].close()
            _put(fs, f"{base}/{name}.off", np.cumsum([0, *state["sizes"]], dtype="<i8").tobytes())
            nulls = np.array([i is pd.NA for i in state["ids"]], dtype=np.uint8)
            _put(fs, f"{base}/{name}.doc", np.array([0 if i is pd.NA else i for i in state["ids"]], dtype="<i8").tobytes() + nulls.tobytes())
            return pd.DataFrame({"bucket": [state["bucket"]], "name": [name], "dtype": [dtype], "docs": [len(state["ids"])], "tokens": [int(sum(state["sizes"]))]})

        fs.create_dir(base, recursive=True)
        for pdf in batches:
            for bucket, part in pdf.groupby("_bucket", sort=True):
                if state.get("bucket") != bucket:
                    if state:
                        yield close()
                    name = f"{int(bucket):06d}-{uuid.uuid4().hex}"
                    state = {"bucket": int(bucket), "name": name, "sizes": [], "ids": [], "bin": fs.open_output_stream(f"{base}/{name}.bin")}
                texts, size, lo = part["text"].tolist(), 0, 0
                for k, t in enumerate([*texts, None]):
                    size += len(t or "")
                    if k == len(texts) or size > FLUSH:
                        got = enc.encode([x or "" for x in texts[lo : k + 1]], end)
                        state["bin"].write(b"".join(got))
                        state["sizes"] += [len(g) // width for g in got]
                        lo, size = k + 1, 0
                state["ids"] += part["doc_id"].astype("Int64").tolist()
        if state:
            yield close()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, end: int | None = 2, folder: str | None = None) -> DataFrame:
    """Write the ids of every whole text in ascending doc_id order; return the
    manifest (bucket, name, dtype, docs, tokens, base, folder), one row per file set.
    Null texts are empty; null ids come last; equal ids are ordered by text; an
    empty table writes nothing and gives an empty manifest."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    n = min(MAX_BUCKETS, partitions(spark) * 4)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bucket = bucket_of(F.col("doc_id"), split_points(rows.select("doc_id"), "doc_id", n))
    rows = rows.withColumn("_bucket", bucket).repartition(n, "_bucket")
    rows = rows.sortWithinPartitions("_bucket", F.asc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    schema = "bucket int, name string, dtype string, docs long, tokens long"
    sets = rows.mapInPandas(writer(folder, lambda: encoder(tokenizer_path), end), schema).checkpoint()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per file set
    return sets.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


def open_set(folder: str, name: str, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets, document ids and null marks of one file set; memory-mapped
    where the folder is on a local file system."""
    fs, base = open_fs(folder)

    def load(ext, kind):
        path = f"{base}/{name}.{ext}"
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, dtype=kind, mode="r") if fs.get_file_info(path).size else np.zeros(0, kind)
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype=kind)

    off, raw = load("off", "<i8"), load("doc", "u1")
    n = len(off) - 1
    return load("bin", dtype), off, raw[: 8 * n].view("<i8"), raw[8 * n :]


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            ids, off, docs, null = open_set(r.folder, r.name, r.dtype)
            for lo in range(0, len(docs), 20_000):
                hi = min(lo + 20_000, len(docs))
                crc = [zlib.crc32(ids[off[i] : off[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                yield pd.DataFrame({"doc_id": pd.arrays.IntegerArray(np.array(docs[lo:hi]), null[lo:hi].astype(bool)), "start": off[lo:hi] + r.base, "n_tokens": off[lo + 1 : hi + 1] - off[lo:hi], "ids_crc32": crc})


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    n = partitions(manifest.sparkSession)
    rows = manifest.select("bucket", "folder", "name", "dtype", "base").repartition(4 * n, "bucket")
    return rows.mapInPandas(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
