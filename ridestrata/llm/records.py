"""Token ids as length-delimited binary records with an index of offsets.

A data file is a row of frames:

    length of the payload (8 bytes), masked CRC-32C of these 8 bytes (4),
    the payload, masked CRC-32C of the payload (4)

and a payload is the doc_id (8 bytes, signed), 1 where the doc_id is null (1 byte),
bytes of an id (1 byte: 2 or 4), two zero bytes, and the ids. All numbers are
little-endian. Beside each data file lies its index with 16 bytes for each record, the
place of its frame and the number of ids before it in the file, so any record can be
read by its number. A manifest names the files in order with their records and ids; it
is written last, by the driver, and files that it does not name do not count. So a task
that is run again, or one that dies half-way, leaves nothing that is read.

Files are written by tasks and read by tasks, a block of records at a time. The driver
holds one line of the manifest per file.
"""

import json
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from tokenizers import Tokenizer

from ridestrata.llm.bpe import byte_characters
from ridestrata.llm.stretches import ROWS_TOGETHER, Stretches, portions
from ridestrata.operators.stored import CLEANUP

ROWS = "doc_id long, start long, ids array<int>"
MANIFEST = "manifest.json"
HEAD, FOOT, ENTRY = 12, 12, 16  #: bytes before and after a payload and its own head; of an index entry
CHUNK = 64  #: bytes whose checksum is taken in one step, for all chunks at once
READ = 4 << 20  #: bytes that a reader asks for at a time, unless one record is larger
BLOCK = 50_000  #: records of a reading task
_MASK = np.uint32(0xA282EAD8)  #: fixed value of the format


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32C, and for each k the change of a checksum when 2**k zero
    bytes follow, as four tables by the bytes of the checksum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    places = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    shifts = [table[places & 255] ^ (places >> 8)]
    for _ in range(40):
        shifts.append(_shifted(shifts[-1], shifts[-1]))
    return table, np.array(shifts)


def _shifted(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


_TABLE, _SHIFTS = _shift_tables()


def _followed(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each checksum after so many zero bytes."""
    for k in range(int(zeros.max(initial=0)).bit_length()):
        moved = np.flatnonzero(zeros >> k & 1)
        crc[moved] = _shifted(_SHIFTS[k], crc[moved])
    return crc


def crc32c(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of stretches of bytes, all at once. A stretch is padded in front to whole
    chunks, which does not change a checksum that begins at zero; the checksums of its
    chunks meet after as many zero bytes as follow them."""
    out = _followed(np.full(len(lengths), 0xFFFFFFFF, np.uint32), lengths)
    chunks = -(-lengths // CHUNK)
    total, ends = int(chunks.sum()), np.cumsum(chunks)
    if total:
        padded = np.zeros(total * CHUNK, np.uint8)
        for start, length, end in zip(starts.tolist(), lengths.tolist(), (ends * CHUNK).tolist()):
            padded[end - length : end] = data[start : start + length]
        crc = np.zeros(total, np.uint32)
        for column in np.ascontiguousarray(padded.reshape(total, CHUNK).T):
            crc = _TABLE[(crc ^ column) & 255] ^ (crc >> 8)
        crc = _followed(crc, (np.repeat(ends, chunks) - np.arange(total) - 1) * CHUNK)
        full = np.flatnonzero(chunks)
        out[full] ^= np.bitwise_xor.reduceat(crc, (ends - chunks)[full])
    return ~out


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + _MASK


def _bytes_at(numbers: np.ndarray, kind: str) -> np.ndarray:
    return numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1)


def framed(doc_ids: pa.Array, ids: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
    """Frames of these sequences, and the length of each."""
    sizes = np.array([len(found) for found in ids], np.int64)
    widths = np.array([4 if len(found) and int(found.max()) > 0xFFFF else 2 for found in ids], np.int64)
    lengths = FOOT + sizes * widths
    heads = np.zeros((len(ids), FOOT), np.uint8)
    heads[:, :8] = _bytes_at(doc_ids.fill_null(0).to_numpy(zero_copy_only=False), "<i8")
    heads[:, 8] = doc_ids.is_null().to_numpy(zero_copy_only=False)
    heads[:, 9] = widths
    bodies = [found.astype("<u2" if width == 2 else "<u4").tobytes() for found, width in zip(ids, widths)]
    payloads = b"".join(part for head, body in zip(heads, bodies) for part in (head.tobytes(), body))
    data = np.frombuffer(payloads, np.uint8)
    ends = np.cumsum(lengths)
    sums = masked(crc32c(data, ends - lengths, lengths))
    fronts = np.empty((len(ids), HEAD), np.uint8)
    fronts[:, :8] = _bytes_at(lengths, "<u8")
    eight = np.full(len(ids), 8, np.int64)
    fronts[:, 8:] = _bytes_at(masked(crc32c(fronts[:, :8].reshape(-1), np.arange(len(ids)) * 8, eight)), "<u4")
    tails = _bytes_at(sums, "<u4")
    parts = []
    for row, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
        parts += (fronts[row].tobytes(), payloads[end - length : end], tails[row].tobytes())
    return b"".join(parts), lengths + HEAD + 4


def unframed(data: bytes, offsets: np.ndarray) -> tuple[list[int | None], list[np.ndarray]]:
    """Ids of documents and of tokens of the frames at these places; raises where a length
    or a checksum is wrong."""
    raw = np.frombuffer(data, np.uint8)
    if len(offsets) and int(offsets[-1]) + HEAD + 4 > len(raw):
        raise ValueError("a record is cut off")
    fronts = raw[offsets[:, None] + np.arange(HEAD)]
    lengths = np.ascontiguousarray(fronts[:, :8]).view("<i8").ravel()
    stated = np.ascontiguousarray(fronts[:, 8:]).view("<u4").ravel()
    found = masked(crc32c(raw, offsets, np.full(len(offsets), 8, np.int64)))
    if (stated != found).any():
        raise ValueError("a record's length does not match its checksum")
    if len(offsets) and (offsets + HEAD + lengths + 4 > len(raw)).any():
        raise ValueError("a record is cut off")
    tails = raw[(offsets + HEAD + lengths)[:, None] + np.arange(4)]
    if (np.ascontiguousarray(tails).view("<u4").ravel() != masked(crc32c(raw, offsets + HEAD, lengths))).any():
        raise ValueError("a record's payload does not match its checksum")
    doc_ids, ids = [], []
    for at, length in zip((offsets + HEAD).tolist(), lengths.tolist()):
        doc_ids.append(None if data[at + 8] else int.from_bytes(data[at : at + 8], "little", signed=True))
        ids.append(np.frombuffer(data, "<u2" if data[at + 9] == 2 else "<u4", (length - FOOT) // data[at + 9], at + FOOT))
    return doc_ids, ids


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    records: int
    tokens: int


class RecordWriter(DataSourceArrowWriter):
    """One data file and one index per task, the manifest at the end. Rows bring ids, or
    texts that the task encodes."""

    def __init__(self, options: dict[str, str]):
        self.path, self.tokenizer = options["path"], options.get("tokenizer")
        self.end = np.array([int(options["end_id"])] if "end_id" in options else [], np.uint32)

    def _portions(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.tokenizer:
            return portions(rows, "text")
        return (rows.slice(row, ROWS_TOGETHER) for row in range(0, rows.num_rows, ROWS_TOGETHER))

    def _ids(self, rows: pa.RecordBatch) -> list[np.ndarray]:
        if self.tokenizer:
            found = _encoder(self.tokenizer).encode_all(pc.fill_null(rows["text"], ""))
        else:
            found = [rows["ids"][row].values.to_numpy(zero_copy_only=False) for row in range(rows.num_rows)]
        return [np.concatenate([ids, self.end]) for ids in found] if len(self.end) else found

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = _place(self.path)
        files.create_dir(folder)
        partition = TaskContext.get().partitionId()
        name, at, tokens, records = f"part-{partition:06d}-{uuid4().hex}", 0, 0, 0
        with files.open_output_stream(f"{folder}/{name}.records") as data, files.open_output_stream(f"{folder}/{name}.index") as index:
            for batch in iterator:
                for part in self._portions(batch):
                    ids = self._ids(part)
                    frames, lengths = framed(part["doc_id"], ids)
                    sizes = np.array([len(found) for found in ids], np.int64)
                    entries = np.stack([at + np.cumsum(lengths) - lengths, tokens + np.cumsum(sizes) - sizes], 1)
                    data.write(frames)
                    index.write(entries.astype("<i8").tobytes())
                    at, tokens, records = at + len(frames), tokens + int(sizes.sum()), records + part.num_rows
        # The worker may stand idle beside those that read the files.
        if self.tokenizer:
            _encoder(self.tokenizer).forget()
        pa.default_memory_pool().release_unused()
        return Written(partition, name, records, tokens)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _place(self.path)
        found = sorted((m for m in messages if m and m.records), key=lambda m: m.partition)
        files.create_dir(folder)
        with files.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps([[m.name, m.records, m.tokens] for m in found]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _place(self.path)
        for message in filter(None, messages):
            for kind in ("records", "index"):
                files.delete_file(f"{folder}/{message.name}.{kind}")


def shuffled_places(count: int, seed: int, places: np.ndarray) -> np.ndarray:
    """Where each place of 0..count-1 goes in a shuffle by seed: four Feistel rounds over
    the next even power of two, again for places that leave the range. No task needs
    more of the shuffle than its own places."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for turn in range(4):
            mixed = (right + np.uint64((seed * 4 + turn) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(31) & low)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= count]
    return out.astype(np.int64)


@dataclass
class Stretch(InputPartition):
    """Records first..last-1 of all, in the order of the read."""

    first: int
    last: int


class RecordReader(DataSourceReader):
    """Blocks of records in order, or shuffled by the option ``seed``."""

    def __init__(self, options: dict[str, str]):
        self.path, self.block = options["path"], int(options.get("block", BLOCK))
        self.seed = int(options["seed"]) if "seed" in options else None
        files, folder = _place(self.path)
        with files.open_input_stream(f"{folder}/{MANIFEST}") as manifest:
            named = json.loads(manifest.read())
        self.names = [name for name, _, _ in named]
        self.ends = np.cumsum([records for _, records, _ in named], dtype=np.int64)
        self.tokens = np.cumsum([0, *(tokens for _, _, tokens in named)], dtype=np.int64)

    def partitions(self) -> list[Stretch]:
        count = int(self.ends[-1]) if len(self.ends) else 0
        if not count:
            return [Stretch(0, 0)]
        if self.seed is not None:
            return [Stretch(at, min(at + self.block, count)) for at in range(0, count, self.block)]
        return [
            Stretch(at, min(at + self.block, int(end)))
            for begin, end in zip([0, *self.ends], self.ends)
            for at in range(int(begin), int(end), self.block)
        ]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        files, folder = _place(self.path)
        first, last = partition.first, partition.last
        if self.seed is not None:
            return self._shuffled(files, folder, first, last)
        return self._in_order(files, folder, first, last) if last > first else iter(())

    def _entries(self, index, first: int, count: int) -> np.ndarray:
        return np.frombuffer(index.read_at(count * ENTRY, first * ENTRY), "<i8").reshape(-1, 2)

    def _batch(self, data: bytes, offsets: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        doc_ids, ids = unframed(data, offsets)
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        columns = [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])

    def _in_order(self, files, folder: str, first: int, last: int) -> Iterator[pa.RecordBatch]:
        file = int(np.searchsorted(self.ends, first, side="right"))
        begin = int(self.ends[file - 1]) if file else 0
        name = f"{folder}/{self.names[file]}"
        with files.open_input_file(f"{name}.index") as index, files.open_input_file(f"{name}.records") as data:
            entries = self._entries(index, first - begin, last - first + 1)
            places = entries[: last - first, 0]
            ends = np.append(entries[1:, 0], data.size())[: last - first]
            at = 0
            while at < len(places):
                till = max(at + 1, int(np.searchsorted(ends, places[at] + READ, side="right")))
                raw = data.read_at(int(ends[till - 1] - places[at]), int(places[at]))
                yield self._batch(raw, places[at:till] - places[at], entries[at:till, 1] + self.tokens[file])
                at = till

    def _shuffled(self, files, folder: str, first: int, last: int) -> Iterator[pa.RecordBatch]:
        """Each record by its place in the index."""
        count = int(self.ends[-1]) if len(self.ends) else 0
        numbers = shuffled_places(count, self.seed, np.arange(first, last))
        for at in range(0, len(numbers), 256):
            part = numbers[at : at + 256]
            owners = np.searchsorted(self.ends, part, side="right")
            frames: list[bytes] = [b""] * len(part)
            starts = np.zeros(len(part), np.int64)
            for file in np.unique(owners).tolist():
                begin, name = (int(self.ends[file - 1]) if file else 0), f"{folder}/{self.names[file]}"
                with files.open_input_file(f"{name}.index") as index, files.open_input_file(f"{name}.records") as data:
                    for slot in np.flatnonzero(owners == file).tolist():
                        place, before = self._entries(index, int(part[slot]) - begin, 1)[0].tolist()
                        head = data.read_at(8, place)
                        frames[slot] = data.read_at(HEAD + int.from_bytes(head, "little") + 4, place)
                        starts[slot] = before + self.tokens[file]
            lengths = np.array([len(frame) for frame in frames], np.int64)
            yield self._batch(b"".join(frames), np.cumsum(lengths) - lengths, starts)


class TokenRecords(DataSource):
    """``spark.read`` and ``write.format("token_records")``. Options: ``path``; for reads
    ``seed`` for a shuffled one and ``block`` for the records of a task; for writes
    ``tokenizer``, the content of a tokenizers file, if rows are (doc_id, text) instead of
    (doc_id, ids), and ``end_id``, an id to write after each sequence."""

    @classmethod
    def name(cls) -> str:
        return "token_records"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        if overwrite:
            raise ValueError("token_records are written once; name a new folder")
        return RecordWriter(dict(self.options))


class Encoder(Stretches):
    """The tokenizers library, with a memory for stretches and pieces, which the library's
    model encodes. A text that may hold an added token goes to the library as it is, and so
    does every text of a tokenizer of another kind."""

    def __init__(self, tokenizer: str):
        self.library = Tokenizer.from_str(tokenizer)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        parts = json.loads(tokenizer)
        split = parts["pre_tokenizer"] or {}
        self.by_pieces = (
            parts["model"]["type"] == "BPE"
            and parts["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
        )
        self.shown = "".join(character for _, character in sorted(byte_characters().items()))
        self.blank = self.shown[ord(" ")]
        self.as_bytes = [number.to_bytes(4, "little") for number in range(self.library.get_vocab_size())]
        self.begin(token["content"] for token in parts["added_tokens"])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_array(text)

    def special(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def piece_ids(self, piece: str) -> bytes:
        shown, as_bytes = charmap_decode(piece.encode(), "strict", self.shown)[0], self.as_bytes
        return b"".join([as_bytes[token.id] for token in self.model.tokenize(shown)])

    def letter_ids(self, word: str) -> bytes:
        as_bytes = self.as_bytes
        return b"".join([as_bytes[token.id] for token in self.model.tokenize(self.blank + word)])


@lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> Encoder:
    """One tokenizer for all tasks of a worker."""
    return Encoder(tokenizer)


def library_file(spark: SparkSession, path: str) -> str:
    """The content of a tokenizer file, by Spark where the path names a file system."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()["value"]
    with open(path, encoding="utf-8") as file:
        return file.read()


def in_id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) dealt by ranges of doc_id and sorted, null ids first. Rows of one
    doc_id are in the order of a hash of their text and may fill several ranges."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("_order", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "_order").sortWithinPartitions("doc_id", "_order", "text")


def write_records(rows: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = None) -> None:
    """Write (doc_id, ids) rows into a new folder, partition after partition, each in its
    order; with the content of a tokenizers file (doc_id, text) rows, whose whole texts the
    writing tasks encode. ``end_id`` follows each sequence. The folder must be shared by
    all executors. An empty table gives a manifest without files. The shuffle files of the
    write go with it."""
    spark = rows.sparkSession
    spark.dataSource.register(TokenRecords)
    writer = rows.select("doc_id", "text" if tokenizer else "ids").write.format("token_records").mode("append")
    options = {"tokenizer": tokenizer, "end_id": end_id}
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer.options(**{name: str(value) for name, value in options.items() if value is not None}).save(path)
    finally:
        spark.conf.set(CLEANUP, before)


def read_records(spark: SparkSession, path: str, seed: int | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, ids) of the records in a folder; ``start`` counts the ids of all
    records before. With a seed the records come shuffled, each read by its place in the
    index. A wrong length or checksum is an error."""
    spark.dataSource.register(TokenRecords)
    reader = spark.read.format("token_records").option("block", block)
    if seed is not None:
        reader = reader.option("seed", seed)
    return reader.load(path)


def token_records(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = 0) -> DataFrame:
    """Write the token ids of ``docs`` (doc_id, text) as records in ascending doc_id order,
    and give the rows (doc_id, start, ids) read back from the files.

    Null and empty texts have the end id alone. Rows with a null doc_id come first.
    Repeated rows are repeated records; rows that share a doc_id are in the order of a
    hash of their text, then of the text. An empty table gives no rows; other columns
    than doc_id and text are not read."""
    spark = docs.sparkSession
    content = library_file(spark, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    write_records(in_id_order(docs), path, content, end_id)
    return read_records(spark, path)


def digests(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of records: the CRC-32 of the ids as unsigned
    32-bit little-endian numbers."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = [batch["ids"][row].values.to_numpy(zero_copy_only=False) for row in range(batch.num_rows)]
            sizes = pa.array([len(found) for found in ids], pa.int64())
            sums = pa.array([crc32(found.astype("<u4").tobytes()) for found in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], sizes, sums], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return records.mapInArrow(batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
