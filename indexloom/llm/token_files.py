"""Token ids in binary files, each a wavelet matrix.

A shard holds the ids of consecutive documents. Its bit-planes, from the highest bit down, are cut into blocks of
2 ** 15 bits that are compressed one by one; a directory has each block's place and the ones before it. A token is
read by walking down the planes with rank, an occurrence is found by walking up with select, and counting needs two
ranks a plane, so each touches a few blocks of the one file.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark import TaskContext

from indexloom.llm.common import give_back
from indexloom.sources.store import new_path, written

MAGIC = b"WVM1"
BLOCK = 1 << 15
SHARD_TOKENS = 1 << 20


class WaveletMatrix:
    """Random access to ids in ``data``, the bytes that ``build`` made."""

    @staticmethod
    def build(ids: np.ndarray, meta: dict | None = None) -> bytes:
        """The file of a sequence of non-negative ids; ``meta`` is kept as JSON."""
        ids = np.asarray(ids)
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        body, directory, zeros = [], [], []
        for k in range(width - 1, -1, -1):
            bit = (now & now.dtype.type(1 << k)).astype(bool)
            zero, one = np.flatnonzero(~bit), np.flatnonzero(bit)
            zeros.append(len(zero))
            ones = 0
            for at in range(0, len(bit), BLOCK):
                raw = np.packbits(bit[at : at + BLOCK]).tobytes()
                small = squeeze(raw)
                body.append(small if len(small) < len(raw) else raw)
                directory.append((len(body[-1]), ones))
                ones += int(np.count_nonzero(bit[at : at + BLOCK]))
            now = np.concatenate([now[zero], now[one]])
        head = zstandard.compress(json.dumps({"n": len(ids), "width": width, "zeros": zeros, "meta": meta or {}}).encode())
        places = zstandard.compress(np.array(directory, "<u4").tobytes())
        return b"".join([MAGIC, struct.pack("<II", len(head), len(places)), head, places, *body])

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        h, p = struct.unpack_from("<II", data, 4)
        head = json.loads(zstandard.decompress(data[12 : 12 + h]))
        self.n, self.width, self.zeros, self.meta = head["n"], head["width"], head["zeros"], head["meta"]
        directory = np.frombuffer(zstandard.decompress(data[12 + h : 12 + h + p]), "<u4").reshape(self.width, -1, 2)
        self._sizes = directory[:, :, 0]
        self._starts = 12 + h + p + np.concatenate([[0], np.cumsum(self._sizes.ravel(), dtype=np.int64)])[:-1].reshape(self._sizes.shape)
        self._before = directory[:, :, 1]
        self._data, self._unpack = data, zstandard.ZstdDecompressor()

    def _bits(self, level: int, block: int) -> np.ndarray:
        start, length = int(self._starts[level, block]), int(self._sizes[level, block])
        raw, n = self._data[start : start + length], min(BLOCK, self.n - block * BLOCK)
        if length < (n + 7) // 8:
            raw = self._unpack.decompress(raw, max_output_size=BLOCK // 8)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).view(bool)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i >= self.n:
            return self.n - self.zeros[level]
        block = i // BLOCK
        return int(self._before[level, block]) + int(np.count_nonzero(self._bits(level, block)[: i % BLOCK]))

    def _select(self, level: int, bit: bool, j: int) -> int:
        """The place of the ``j``-th (from 0) such bit of a plane."""
        ones = self._before[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = bisect_right(before.tolist(), j) - 1
        bits = self._bits(level, block)
        return block * BLOCK + int(np.flatnonzero(bits if bit else ~bits)[j - int(before[block])])

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.width):
            bit = bool(self._bits(level, i // BLOCK)[i % BLOCK])
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for level in range(self.width):
            a, b = self._ones(level, start), self._ones(level, end)
            start, end = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.width - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` occurs in the ids from ``start`` to before ``end``."""
        end = self.n if end is None else min(end, self.n)
        if token < 0 or token >> self.width or start >= end:
            return 0
        a, b = self._range(token, start, end)
        return b - a

    def find(self, token: int, j: int) -> int:
        """The place of the ``j``-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        if token < 0 or token >> self.width or not 0 <= j < self.count(token):
            return -1
        i = self._range(token, 0, 0)[0] + j
        for level in range(self.width - 1, -1, -1):
            bit = bool(token >> (self.width - 1 - level) & 1)
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the lowest."""
        now = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for level in range(self.width - 1, -1, -1):
            if not self.n:
                break
            bit = np.concatenate([self._bits(level, b) for b in range(self._sizes.shape[1])])
            zero, one = np.flatnonzero(~bit), np.flatnonzero(bit)
            before = np.empty_like(now)
            before[zero] = now[: len(zero)]
            before[one] = now[len(zero) :] | now.dtype.type(1 << (self.width - 1 - level))
            now = before
        return now


class _Known(dict):
    """Values by key, made where they are missing. Long keys are not kept, and beyond ``most`` the later half goes.

    The common words of a corpus are met first, so what stays is what is asked for most.
    """

    LONGEST = 64

    def __init__(self, make: Callable[[str], bytes], most: int):
        self._make, self._most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self._make(key)
        if len(key) <= self.LONGEST:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self._most:
            kept = list(islice(self.items(), self._most // 2))
            self.clear()
            self.update(kept)


class Encoder:
    """Ids of texts, as the tokenizer gives them, by encoding each space-parted word once.

    The tokenizer of the JSON turns white space into a space, never joins pieces over it and drops it, so a text's
    ids are those of its words in turn; ``by_words`` states that this holds. A word of Latin letters is one piece to
    the model, whatever ASCII marks follow it. Other tokenizers, with ``by_words`` off, encode whole texts.
    """

    WORDS = 800_000
    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%$#&*]*)")

    def __init__(self, tokenizer_json: str, by_words: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_words = Tokenizer.from_str(tokenizer_json), by_words
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._code = "H" if self.dtype is np.uint16 else "I"
        self._words = _Known(self._word, self.WORDS)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        #: The byte-level alphabet: a visible byte is its own character, the others follow from U+0100.
        self._alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _general(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        m = self._PLAIN.fullmatch(word)
        if not m:
            return self._general(word)
        if m[2]:
            return self._words[m[1]] + self._words[m[2]]
        letters = word.lower()
        spelled = letters if letters.isascii() else "".join(map(self._alphabet.__getitem__, letters.encode()))
        return array(self._code, [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    @staticmethod
    def _folded(text: str) -> str:
        """In lower case, which the tokenizer makes it, where Python's rule is surely the same: Latin-1 without specials."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text if "<|" in text else text.lower()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return [self._general(x) for x in texts]
        out = []
        for text in texts:
            out.append(b"".join(map(self._words.__getitem__, self._folded(text).replace("\n", " ").split(" "))))
            self._words.trim()
        return out


@lru_cache(maxsize=1)
def encoder_of(tokenizer_json: str, by_words: bool) -> Encoder:
    """The worker's encoder, which its later tasks find with the words of its earlier ones."""
    return Encoder(tokenizer_json, by_words)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else "file:" + path.removeprefix("file:"))


def write_token_files(docs: DataFrame, tokenizer_json: str, end_id: int, folder: str | None = None, shard_tokens: int = SHARD_TOKENS, by_words: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of id; a row per file comes back.

    The rows are ``part`` and ``seq`` (the order of files), ``path``, ``n_docs`` and ``n_tokens``. A file holds whole
    documents and closes at ``shard_tokens``; a longer document makes a longer file. Null texts are empty, null ids
    come first, rows with one id are in order of a hash of their texts. ``folder`` must be shared by all executors; the default
    is a new one beside the working tables. Repeated tasks write files of other names; only listed ones are read.
    """
    spark = docs.sparkSession
    shared, folder = spark.sparkContext.broadcast(tokenizer_json), folder or new_path(spark, "tokens")
    # The bounds of ranges are collected, so they are ids and hashes, not texts.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc_nulls_first()]
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system, base = _open(folder)
        encoder, ids, sizes, names, seq = encoder_of(shared.value, by_words), [], [], [], 0
        end = encoder.dtype(end_id).tobytes()

        def close() -> pa.RecordBatch:
            nonlocal ids, sizes, names, seq
            tokens = np.frombuffer(b"".join(ids), encoder.dtype)
            path = f"{base}/shard-{part:06d}-{seq:06d}-{attempt}.wvm"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(path) as out:
                out.write(WaveletMatrix.build(tokens, {"docs": names, "sizes": sizes}))
            row = [[part], [seq], [f"{folder}/{path.rpartition('/')[2]}"], [len(names)], [len(tokens)]]
            ids, sizes, names, seq = [], [], [], seq + 1
            return pa.RecordBatch.from_arrays([pa.array(x[0], pa.string() if isinstance(x[0][0], str) else pa.int64()) for x in ([r] for r in row)], ["part", "seq", "path", "n_docs", "n_tokens"])

        held = 0
        for batch in batches:
            for key, value in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                coded = encoder.encode([value.as_py() or ""])[0] + end
                ids.append(coded)
                names.append(key)
                sizes.append(len(coded) // len(end))
                held += sizes[-1]
                if held >= shard_tokens:
                    yield close()
                    held = 0
        if names:
            yield close()
        give_back()

    ranged = own.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(run, "part long, seq long, path string, n_docs long, n_tokens long"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the listed files, from the files alone.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is that of its ids as little-endian 32-bit.
    """

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                system, at = _open(path)
                with system.open_input_stream(at) as source:
                    matrix = WaveletMatrix(source.read())
                ids, sizes = matrix.ids().astype("<u4"), np.array(matrix.meta["sizes"], np.int64)
                ends = np.cumsum(sizes)
                data = memoryview(ids).cast("B")
                crc = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(matrix.meta["docs"], pa.int64()), pa.array(first + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A row for each part; a part's files are ordered by a window of its own.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = files.withColumn("inner", inner).join(parts, "part").select("path", (F.col("before") + F.col("inner")).alias("first"))
    # A fixed number of tasks: rows are paths, whose sizes say nothing of the work.
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tasks.repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
