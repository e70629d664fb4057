"""Token-id files: each document compressed by itself with a zstandard dictionary that all share.

Short arrays of ids compress badly alone; a dictionary trained on serialized ids of sample documents gives
each of them a common past. A file holds the documents of one stretch of the doc_id order:

    magic "TIDS0001", the dictionary's SHA-256 (32 bytes), bytes an id (u8), documents (u64)
    index, a record a document: doc_id (i64), no id (u8), ids (u64), end of its frame (u64)
    frames, one zstandard frame a document

All numbers are little-endian. A document is found by its record and read by its frame alone. The dictionary
is a file beside them, named by its hash; a reader refuses another. Tasks write files under names of their
own, and only those that their successful attempts report are listed, so a lost or repeated task leaves no
wrong file in the list. Files go through a file system URI (a shared folder, HDFS, an object store).
"""

from __future__ import annotations

import hashlib
import operator
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import _SEPARATORS, LATIN, Kept
from .common import checkpoint_dir, cut, give_back, table
from .op4_bpe import _byte_symbols

VOCABULARY, END = "word_bpe_49k.json", 1
MAGIC = b"TIDS0001"
#: Stands between chunks that are encoded in one call.
MARK = "\x00"
RECORD = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("ids", "<u8"), ("end", "<u8")])
#: Bytes of frames after which a task begins another file.
FILE_BYTES = 16 << 20
#: Chunks in each generation that a worker keeps: short strings and a few bytes each.
KEPT = 400_000
#: Bytes of texts that are split, looked up and put together at once: chunks that come again among them are looked up once.
GROUP = 8 << 20
#: The dictionary's size, and the bounds of its sample: documents, and of each so many pieces of so many characters.
DICTIONARY, SAMPLE, PIECES, PIECE, LEVEL = 64 << 10, 1000, 8, 2000, 3


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    system, path = _fs(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)


def read_file(uri: str, at: int = 0, size: int | None = None) -> bytes:
    system, path = _fs(uri)
    with system.open_input_file(path) as f:
        return f.read_at(f.size() - at if size is None else size, at)


class Shard:
    """A file in the making."""

    def __init__(self, dictionary: bytes, width: int):
        import zstandard

        self.head = MAGIC + hashlib.sha256(dictionary).digest() + bytes([width])
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True, write_dict_id=False).compress
        self.records, self.frames, self.size = [], [], 0

    def add(self, doc_id: int | None, ids: bytes, n: int) -> None:
        frame = self.press(ids)
        self.size += len(frame)
        self.frames.append(frame)
        self.records.append((doc_id or 0, doc_id is None, n, self.size))

    def data(self) -> bytes:
        return b"".join([self.head, len(self.records).to_bytes(8, "little"), np.array(self.records, RECORD).tobytes(), *self.frames])


class Reader:
    """Reads whole files (bytes) or single documents by ranges of a file at a URI."""

    HEAD = len(MAGIC) + 32 + 1 + 8

    def __init__(self, dictionary: bytes):
        import zstandard

        self.hash = hashlib.sha256(dictionary).digest()
        self.open = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress

    def head(self, data: bytes) -> tuple[int, int]:
        """(bytes an id, documents) of a file that begins so."""
        if data[: len(MAGIC)] != MAGIC or data[len(MAGIC) : len(MAGIC) + 32] != self.hash:
            raise ValueError("not a token file, or one of another dictionary")
        return data[len(MAGIC) + 32], int.from_bytes(data[self.HEAD - 8 : self.HEAD], "little")

    def documents(self, data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
        width, n = self.head(data)
        index = np.frombuffer(data, RECORD, n, self.HEAD)
        base = self.HEAD + n * RECORD.itemsize
        begin = base
        for doc_id, no_id, _, end in index.tolist():
            yield None if no_id else doc_id, np.frombuffer(self.open(data[begin : base + end]), f"<u{width}")
            begin = base + end

    def document(self, uri: str, k: int) -> np.ndarray:
        """The ids of the k-th document of a file, by reading its record and its frame only."""
        width, n = self.head(read_file(uri, 0, self.HEAD))
        if not 0 <= k < n:
            raise IndexError(k)
        first = max(0, k - 1)
        near = np.frombuffer(read_file(uri, self.HEAD + first * RECORD.itemsize, (k - first + 1) * RECORD.itemsize), RECORD)
        begin, end = (int(near[0]["end"]) if k else 0), int(near[-1]["end"])
        return np.frombuffer(self.open(read_file(uri, self.HEAD + n * RECORD.itemsize + begin, end - begin)), f"<u{width}")


def _joined(kept: Kept, texts: pa.LargeStringArray) -> list[bytes]:
    """What the chunks of each text give, one behind the other.

    Arrow splits texts, finds the distinct chunks and puts the values together; only distinct chunks go through Python.
    """
    lists = pc.utf8_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))  # as chunks() does
    each = lists.flatten().dictionary_encode()
    # an index of a chunk and an end of its values is a number for each chunk of the group
    found = pa.array(kept.values(each.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(each.indices)
    _, ends, data = found.buffers()
    if not len(found):
        return [b""] * len(texts)
    at = np.frombuffer(ends, np.int64, len(found) + 1, found.offset * 8)[np.asarray(lists.offsets) - lists.offsets[0].as_py()].tolist()
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in pairwise(at)]


def _plain(t, together: Callable, width: int) -> Callable:
    """together() with a short way for words of Latin letters, if the tokenizer gives for them what its model gives for their bytes in lower case.

    They come through normalizing and pre-splitting as one piece, and these take longer than the merges.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    model = Tokenizer(t.model)
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    suffix, size = getattr(t.model, "end_of_word_suffix", None), t.get_vocab_size(True)
    if not suffix:
        return together
    last = np.array([(t.id_to_token(i) or "").endswith(suffix) for i in range(size)])
    symbols = np.array([ord(x) for x in _byte_symbols()], "<u2")
    symbols[ord(" ")] = ord(" ")

    def letters(words: list[str]) -> list[bytes] | None:
        out = []
        for k in range(0, len(words), 500):
            some = words[k : k + 500]
            text = " ".join(some)
            if not text.isascii():
                text = symbols[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(model.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{width}")
            cuts = ((np.flatnonzero(last[ids]) + 1) * width).tolist()
            if len(cuts) != len(some):
                return None
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        return out

    every = [c for c in map(chr, range(ord(LATIN))) if c.lower().isalpha() and max(c.lower()) < LATIN]
    tried = [*every, *(f"a{c}b" for c in every), "".join(every), *map("".join, pairwise(every))]
    if letters([x.lower() for x in tried]) != together(tried):
        return together

    def made(new: list[str]) -> list[bytes]:
        low = [c.lower() for c in new]
        short = [c.isalpha() and (c.isascii() or max(c) < LATIN) for c in low]
        found = letters([c for c, s in zip(low, short, strict=True) if s])
        if found is None:
            return together(new)
        words, rest = iter(found), iter(together([c for c, s in zip(new, short, strict=True) if not s]))
        return [next(words) if s else next(rest) for s in short]

    return made


@cache
def _encoder(name: str) -> tuple:
    """(texts, an array -> their serialized ids, bytes an id); one for each worker process.

    Where the tokenizer drops white space, chunks between it are encoded by the library once and kept.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_padding()
    t.no_truncation()
    width = 2 if t.get_vocab_size(True) <= 1 << 16 else 4

    def alone(new: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{width}").tobytes() for e in t.encode_batch_fast(new, add_special_tokens=False)]

    def together(new: list[str]) -> list[bytes]:
        """Many chunks in one text with a mark between that is a token of its own; where a chunk has it too, one by one."""
        out = []
        for k in range(0, len(new), 500):
            some = new[k : k + 500]
            ids = np.array(t.encode_batch_fast([f" {MARK} ".join(some)], add_special_tokens=False)[0].ids, f"<u{width}")
            cuts = (np.flatnonzero(ids == mark[0]) * width).tolist()
            if len(cuts) != len(some) - 1:
                out += alone(some)
                continue
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *(c + width for c in cuts)], [*cuts, len(data)], strict=True)]
        return out

    def ids_of(texts: list[str]) -> list[int]:
        return [i for e in t.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids]

    mark = ids_of([MARK])
    # lower case, no white space, and words apart from marks
    if len(mark) == 1 and ids_of(["Ab, c \n\td"]) == ids_of(["ab", ",", "c", "d"]):
        kept = Kept(_plain(t, together, width), KEPT, operator.add)

        def encode(texts: pa.LargeStringArray) -> list[bytes]:
            odd = pc.match_substring_regex(texts, f"[{_SEPARATORS}]")  # Arrow splits at these as well
            if not pc.any(odd).as_py():
                return _joined(kept, texts)
            apart = map(b"".join, list(kept.of(texts.filter(odd).to_pylist())))
            rest = iter(_joined(kept, texts.filter(pc.invert(odd))))
            return [next(apart) if x else next(rest) for x in odd.to_pylist()]

        return encode, width
    return (lambda texts: [alone([x])[0] for x in texts.to_pylist()]), width


def _groups(texts: pa.Array) -> Iterator[pa.LargeStringArray]:
    """The texts in turn, about GROUP bytes at a time; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts):
        group = np.cumsum(pc.binary_length(texts).to_numpy()) // GROUP
        yield from (texts[a:b] for a, b in pairwise([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]))


def serialized(texts, name: str = VOCABULARY, end: int | None = END) -> Iterator[bytes]:
    """The serialized ids of each text (a list or an array of Arrow's) in order."""
    encode, width = _encoder(name)
    last = b"" if end is None else end.to_bytes(width, "little")
    if not isinstance(texts, pa.Array):
        texts = pa.array([x if x is None else x.encode("utf-8", "replace").decode() for x in texts], pa.large_string())
    for group in _groups(texts):
        for data in encode(group):
            yield data + last


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they have GROUP bytes."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size >= GROUP:
            yield pa.Table.from_batches(some)
            some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def _spread(text: Column) -> Column:
    """A text of PIECES times PIECE characters or less, else so many pieces from its begin to its end."""
    n = F.length(text)
    starts = [F.floor((n - PIECE) * (k / (PIECES - 1))).cast("int") + 1 for k in range(PIECES)]
    return F.when(n <= PIECES * PIECE, text).otherwise(F.concat_ws(" ", *[F.substring(text, s, F.lit(PIECE)) for s in starts]))


def dictionary(docs: DataFrame, name: str = VOCABULARY) -> bytes:
    """Trained on ids from all over the texts of a bounded sample of documents; where zstandard finds too little to train on, their ids as they are."""
    import zstandard

    share = min(1.0, 2 * SAMPLE / max(1, docs.count()))  # so that tasks hold back few rows each
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = docs.where(F.col("text").isNotNull() & (ticket < int(share * (1 << 30)))).select(_spread(F.col("text")).alias("text"), ticket.alias("h")).orderBy("h", "text").limit(SAMPLE).collect()
    some = list(serialized((r.text for r in rows), name))
    try:
        return zstandard.train_dictionary(DICTIONARY, some).as_bytes()
    except zstandard.ZstdError:
        return b"".join(some)[:DICTIONARY]


def write(docs: DataFrame, folder: str, name: str = VOCABULARY, end: int | None = END) -> DataFrame:
    """Writes the ids of docs (doc_id, text) in ascending doc_id order and gives the list of files.

    A row a file: uri, first (its place in the order), documents, ids, and start (ids of all files before).
    Rows without an id come first, rows with one id by their texts' hashes, so that many of either are dealt
    to many tasks; null texts are empty. Null-only or empty tables give what they hold: an end id for each
    row, or no file.
    """
    shared = dictionary(docs, name)
    write_file(f"{folder}/{hashlib.sha256(shared).hexdigest()}.dictionary", shared)
    seen = docs.sparkSession.sparkContext.broadcast(shared)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        width, part, k, shard = _encoder(name)[1], TaskContext.get().partitionId(), 0, Shard(seen.value, _encoder(name)[1])

        def done() -> pa.RecordBatch:
            uri = f"{folder}/part-{part:06d}-{k:05d}-{uuid.uuid4().hex}.tids"
            write_file(uri, shard.data())
            row = {"uri": uri, "part": part, "k": k, "documents": len(shard.records), "ids": sum(r[2] for r in shard.records)}
            return pa.RecordBatch.from_pylist([row], pa.schema({"uri": pa.string(), "part": pa.int32(), "k": pa.int32(), "documents": pa.int64(), "ids": pa.int64()}))

        for some in _gathered(batches):
            for doc_id, data in zip(some["doc_id"].to_pylist(), serialized(some["text"].cast(pa.large_string()).combine_chunks(), name, end), strict=True):
                shard.add(None if doc_id is None else int(doc_id), data, len(data) // width)
                if shard.size >= FILE_BYTES:
                    yield done()
                    k, shard = k + 1, Shard(seen.value, width)
        if shard.records:
            yield done()
        give_back()

    order = [F.asc_nulls_first("doc_id"), F.asc("body")]
    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("body")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    made = cut(dealt.select("doc_id", "text").mapInArrow(files, "uri string, part int, k int, documents long, ids long"))
    before = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    return made.select("uri", F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("first"), "documents", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))


def read(listed: DataFrame, folder: str) -> DataFrame:
    """Per document of the listed files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    files = listed.count()

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers: dict[bytes, Reader] = {}
        for batch in batches:
            for uri, at in zip(batch["uri"], batch["start"].tolist(), strict=True):
                data = read_file(uri)
                key = data[len(MAGIC) : len(MAGIC) + 32]
                reader = readers.get(key) or readers.setdefault(key, Reader(read_file(f"{folder}/{key.hex()}.dictionary")))
                rows = []
                for doc_id, ids in reader.documents(data):
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    return listed.select("uri", "start").repartition(max(1, files)).mapInPandas(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    return read(write(table(spark, sf_dir, "documents"), folder), folder)
