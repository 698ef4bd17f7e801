"""Token-ID output (operator 12): documents as token ids, compressed one by one with a shared zstandard dictionary.

A store is a folder that driver and executors share.  It holds `dictionary` (the zstandard dictionary, trained on serialized id arrays of
a sample), token files, and `manifest` (Parquet: which files there are, their documents and tokens, in order).  A token file is

    MAGIC | sha256 of the dictionary | a zstandard frame per document | index | number of documents, start of the index, MAGIC

where the index holds, per document, its doc_id, whether that is null, and the ends of its frame and of its ids in the file: a document
is read by one look at the index and one at its frame.  Ids are little-endian unsigned 32-bit integers and end with end_id.

Texts are encoded and compressed where they lie; only frames are shuffled, to ranges of (doc_id, number of the row), so that the rows of a
doc_id of which there are many, or of none, spread over tasks as well.  Every task writes its range into files of its own names and gives
back their manifest rows.  A task that runs again writes new files, and files that no manifest row names do not count: a lost executor
leaves no half-written document in the store.  Files are written and read by pyarrow.fs, which reaches the common shared file systems.

The dictionary learns from SAMPLE_TEXTS texts at most, those with the smallest hashes, and SAMPLE_CHARS characters from anywhere in each;
it changes sizes only, never ids.

Defined results.  Null or empty text: end_id alone.  Repeated rows and repeated doc_ids: each row is a document of its own, beside those of
its doc_id; null doc_ids come last.  Empty table: a store without files, no rows.  Very long texts are encoded in parts, into one frame.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from zlib import crc32

from cardloom.llm.common import bounded_rows, staged, trim_memory, with_small_batches
from cardloom.llm.packing import WordEncoder
from cardloom.sources.staging import shared_root

#: Texts that the dictionary learns from, characters of each, and its size in bytes.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8000, 64 << 10
LEVEL = 3
#: Bytes of frames, and documents, after which a file is closed.
FILE_BYTES, FILE_DOCUMENTS = 64 << 20, 1 << 20
#: Characters of text that are encoded at once: of more words at a time fewer are new.
SLICE_CHARS = 4_000_000
#: Bytes of frames or ids that a task hands over or reads at once.
CHUNK_BYTES = 4 << 20

MAGIC = b"TOKIDS\x00\x01"
_HEAD, _FOOT = struct.Struct("<8s32s"), struct.Struct("<QQ8s")
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frame_end", "<u8"), ("ids_end", "<u8")])


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class Dictionary:
    def __init__(self, raw: bytes) -> None:
        self.raw, self.sha256 = raw, hashlib.sha256(raw).digest()

    @staticmethod
    def trained(samples: list[bytes]) -> Dictionary:
        """Of serialized id arrays; of too few of them, their own bytes serve as they are."""
        try:
            return Dictionary(zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8).as_bytes())
        except zstandard.ZstdError:
            return Dictionary((b"".join(samples) + bytes(8))[:DICTIONARY_BYTES])

    def compressor(self) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(self.raw)
        own.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True)

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(self.raw))


class TokenFileWriter:
    """Writes one token file, frame by frame."""

    def __init__(self, file, sha256: bytes) -> None:
        self.file, self.index, self.bytes, self.tokens = file, [], 0, 0
        file.write(_HEAD.pack(MAGIC, sha256))

    def add(self, doc_id: int | None, tokens: int, frame: bytes) -> None:
        self.file.write(frame)
        self.bytes += len(frame)
        self.tokens += tokens
        self.index.append((doc_id or 0, doc_id is None, self.bytes, self.tokens))

    def close(self) -> None:
        self.file.write(np.array(self.index, _INDEX).tobytes())
        self.file.write(_FOOT.pack(len(self.index), _HEAD.size + self.bytes, MAGIC))
        self.file.close()


class TokenFile:
    """Reads one token file: any document by its place, or all in turn."""

    def __init__(self, file, dictionary: Dictionary) -> None:
        self.file = file
        size = file.size()
        if size < _HEAD.size + _FOOT.size:
            raise ValueError("this is no token file")
        magic, sha256 = _HEAD.unpack(self._read(0, _HEAD.size))
        documents, at, end = _FOOT.unpack(self._read(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("this is no token file")
        if sha256 != dictionary.sha256:
            raise ValueError("the file was written with another dictionary")
        self.index = np.frombuffer(self._read(at, documents * _INDEX.itemsize), _INDEX)
        self.frame_ends = np.concatenate([[0], self.index["frame_end"].astype(np.int64)])
        self.starts = np.concatenate([[0], self.index["ids_end"].astype(np.int64)])
        self.unpack = dictionary.decompressor()

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def doc_id(self, place: int) -> int | None:
        return None if self.index["null"][place] else int(self.index["doc_id"][place])

    def ids(self, place: int) -> bytes:
        """The ids of one document."""
        a, b = self.frame_ends[place : place + 2].tolist()
        return self.unpack.decompress(self._read(_HEAD.size + a, b - a))

    def places(self, doc_id: int | None) -> range:
        """Where the documents of a doc_id are; files are sorted by it, null last."""
        known = len(self.index) - int(self.index["null"].sum())
        if doc_id is None:
            return range(known, len(self.index))
        a, b = (np.searchsorted(self.index["doc_id"][:known], doc_id, side).item() for side in ("left", "right"))
        return range(a, b)

    def __iter__(self) -> Iterator[bytes]:
        place = 0
        while place < len(self.index):
            # as many frames as a chunk holds, one at least
            begin = self.frame_ends[place].item()
            stop = max(place + 1, np.searchsorted(self.frame_ends, begin + CHUNK_BYTES, "right").item() - 1)
            raw = memoryview(self._read(_HEAD.size + begin, self.frame_ends[stop].item() - begin))
            for a, b in zip((self.frame_ends[place:stop] - begin).tolist(), (self.frame_ends[place + 1 : stop + 1] - begin).tolist()):
                yield self.unpack.decompress(raw[a:b])
            place = stop


@dataclass(frozen=True)
class TokenStore:
    """folder: where the store is, as a URI.  manifest: path, first and last place in order, documents, tokens and start of every file."""

    folder: str
    dictionary: Dictionary
    manifest: DataFrame


def sample_texts(docs: DataFrame) -> DataFrame:
    """text: windows of the SAMPLE_TEXTS different texts with the smallest hashes, and a few more."""
    rows = docs.filter("text <> ''").select("text", F.xxhash64("text").alias("h"))
    many = rows.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    chance = min(1.0, (1.1 * SAMPLE_TEXTS + 16) / max(1, 0.9 * many - 1))
    drawn = rows.filter(F.pmod("h", F.lit(1 << 40)) < chance * (1 << 40))
    begin = 1 + F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1))
    return drawn.select("h", F.substr("text", begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("text")).groupBy("h").agg(F.first("text").alias("text")).orderBy("h").limit(SAMPLE_TEXTS).select("text")


def train(docs: DataFrame, tokenizer_path: str) -> Dictionary:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(encoder.encode_all(batch.column(0).to_pylist())), pa.binary())], ["ids"])

    samples = bounded_rows(sample_texts(docs).mapInArrow(encode, "ids binary"), SAMPLE_TEXTS, "the sample")
    return Dictionary.trained(sorted(bytes(r["ids"]) for r in samples if r["ids"]))


def token_frames(docs: DataFrame, tokenizer_path: str, dictionary: Dictionary, end_id: int) -> DataFrame:
    """doc_id, tokens and frame of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary.raw)
    stop = np.array([end_id], "<u4").tobytes()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        encoder, pack = WordEncoder(tokenizer_path, SLICE_CHARS), Dictionary(shared.value).compressor()
        trim_memory()
        for batch in _gathered(batches):
            held: list[tuple] = []
            size = 0
            for doc, raw in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1).to_pylist())):
                held.append((doc, len(raw) // 4 + 1, pack.compress(raw + stop)))
                size += len(held[-1][2])
                if size > CHUNK_BYTES:
                    yield _batch(held, ["doc_id", "tokens", "frame"], [pa.int64(), pa.int64(), pa.binary()])
                    held, size = [], 0
            if held:
                yield _batch(held, ["doc_id", "tokens", "frame"], [pa.int64(), pa.int64(), pa.binary()])
        del encoder
        trim_memory()

    return with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(compress, "doc_id long, tokens long, frame binary")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of doc_ids and texts, joined until they have about SLICE_CHARS bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= SLICE_CHARS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def new_folder(spark: SparkSession) -> str:
    """A new folder for a store, as a full URI."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> TokenStore:
    """Write all documents to a new store."""
    spark = docs.sparkSession
    folder = (folder or new_folder(spark)).rstrip("/")
    dictionary = train(docs, tokenizer_path)
    system, path = _file_system(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/dictionary") as f:
        f.write(dictionary.raw)
    frames = staged(token_frames(docs, tokenizer_path, dictionary, end_id).withColumn("row", F.monotonically_increasing_id()), "frames")
    size = frames.agg(F.coalesce(F.sum(F.octet_length("frame")), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    sha256, names = dictionary.sha256, ["part", "number", "file", "first_doc", "last_doc", "documents", "tokens", "bytes"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, path = _file_system(folder)
        part, number, writer, name = TaskContext.get().partitionId(), 0, None, ""

        def closed() -> pa.RecordBatch:
            writer.close()
            first, last = writer.index[0], writer.index[-1]
            row = (part, number, name, None if first[1] else first[0], None if last[1] else last[0], len(writer.index), writer.tokens, writer.bytes)
            return _batch([row], names, kinds)

        for batch in batches:
            for doc, tokens, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if writer is None:
                    name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex}.tokens"
                    writer = TokenFileWriter(system.open_output_stream(f"{path}/{name}"), sha256)
                writer.add(doc, tokens, frame.as_py())
                if writer.bytes >= FILE_BYTES or len(writer.index) >= FILE_DOCUMENTS:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()
        trim_memory()

    written = staged(
        frames.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "tokens", "frame").mapInArrow(write, "part int, number int, file string, first_doc long, last_doc long, documents long, tokens long, bytes long"), "written"
    )
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")
    return open_store(spark, folder)


def open_store(spark: SparkSession, folder: str) -> TokenStore:
    system, path = _file_system(folder)
    with system.open_input_file(f"{path}/dictionary") as f:
        dictionary = Dictionary(f.read())
    return TokenStore(folder, dictionary, spark.read.parquet(f"{folder}/manifest"))


def _scan(store: TokenStore, finish, shape: str, kind: pa.DataType, files: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens and finish(ids) of every document of the store, a task for every few files."""
    folder, shared = store.folder, store.manifest.sparkSession.sparkContext.broadcast(store.dictionary.raw)
    files = store.manifest if files is None else files
    name = shape.split()[0]
    kinds = [pa.int64(), pa.int64(), pa.int64(), kind]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        dictionary = Dictionary(shared.value)
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{path}/{file}") as f:
                    tokens = TokenFile(f, dictionary)
                    held, size = [], 0
                    for place, ids in enumerate(tokens):
                        held.append((tokens.doc_id(place), start + tokens.starts[place].item(), len(ids) // 4, finish(ids)))
                        size += len(ids)
                        if size > CHUNK_BYTES:
                            yield _batch(held, ["doc_id", "start", "n_tokens", name], kinds)
                            held, size = [], 0
                    if held:
                        yield _batch(held, ["doc_id", "start", "n_tokens", name], kinds)
        trim_memory()

    many = files.count()
    dealt = files.select("file", "start").repartitionByRange(max(1, many), "start") if many > 1 else files.select("file", "start")
    return dealt.mapInArrow(read, f"doc_id long, start long, n_tokens long, {shape}")


def read_ids(store: TokenStore) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (binary) of every document."""
    return _scan(store, bytes, "ids binary", pa.binary())


def read_digests(store: TokenStore) -> DataFrame:
    """Like read_ids, with ids_crc32 instead of the ids themselves."""
    return _scan(store, crc32, "ids_crc32 long", pa.int64())


def fetch(store: TokenStore, doc_ids: Iterable[int]) -> DataFrame:
    """doc_id and ids of a few documents: only files whose range holds one of them are opened, and only their frames read."""
    wanted = sorted(set(doc_ids))
    folder, shared = store.folder, store.manifest.sparkSession.sparkContext.broadcast(store.dictionary.raw)
    inside = F.lit(False)
    if wanted:
        near = F.filter(F.lit(wanted), lambda x: (x >= F.col("first_doc")) & (x <= F.coalesce("last_doc", F.lit((1 << 63) - 1))))
        inside = F.size(near) > 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        dictionary = Dictionary(shared.value)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with system.open_input_file(f"{path}/{file}") as f:
                    tokens = TokenFile(f, dictionary)
                    if found := [(doc, tokens.ids(place)) for doc in wanted for place in tokens.places(doc)]:
                        yield _batch(found, ["doc_id", "ids"], [pa.int64(), pa.binary()])

    return store.manifest.filter(inside).select("file").mapInArrow(read, "doc_id long, ids binary")
