"""Byte-level BPE: encoding by a queue of merge ranks, decoding by vocabulary strings.

A piece of text is a doubly linked list of symbols. A queue holds the mergeable
neighbours by rank and place; the head is merged, its new neighbours are queued, and
entries whose symbols have changed since are skipped when they come up. A piece of n
symbols takes n log n steps however long it is.

The vocabulary is read on the driver and goes to the tasks with the function: its
size is that of one tokenizer file, whatever the data."""

import heapq
import json
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.llm.stretches import Stretches, portions


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: printable Latin-1
    characters for themselves, the others from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ByteBpe(Stretches):
    """A tokenizer from the parts of its file: vocabulary, merges, added tokens."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int]):
        as_byte = {character: byte for byte, character in byte_characters().items()}
        self.strings = {str(number): bytes(as_byte[c] for c in token) for token, number in vocabulary.items()}
        self.strings |= {str(number): token.encode() for token, number in added.items()}
        self.byte_ids = [vocabulary.get(c, -1) for _, c in sorted(byte_characters().items())]
        # Merges: by the left id, the rank of each right id; by rank, the id that they make.
        self.ranks: dict[int, dict[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self.ranks.setdefault(vocabulary[a], {})[vocabulary[b]] = rank
        self.made = [vocabulary[a + b] for a, b in merges]
        self.added = added
        self._compile()

    # A piece takes longer to merge than to find, but a worker's memory counts for more.
    thrift = 2
    pieces_kept = 50_000

    def _compile(self) -> None:
        last, none = max(map(int, self.strings), default=-1), {}
        self._rights = [self.ranks.get(number, none).get for number in range(last + 1)] + [none.get]
        self.begin(self.added)
        numbers = [str(number) for number in range(last + 1)]
        self._decimals = pa.array(numbers, pa.large_string())
        self._bytes = pa.array([self.strings.get(number) for number in numbers], pa.large_binary())

    def __getstate__(self):
        return {name: self.__dict__[name] for name in ("strings", "byte_ids", "ranks", "made", "added")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._compile()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece. A queue entry is a rank and a place in one number; it is
        stale if the symbols there no longer make a pair of that rank."""
        ids = [self.byte_ids[byte] for byte in piece]
        n, rights, made = len(ids), self._rights, self.made
        shift = max(13, n.bit_length())
        place = (1 << shift) - 1
        # The rank of each symbol with the one after it, -1 if they do not merge.
        ranks = [rights[a](b, -1) for a, b in zip(ids, ids[1:])]
        ranks.append(-1)
        queue = [rank << shift | i for i, rank in enumerate(ranks) if rank >= 0]
        if not queue:
            return ids
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = pop(queue)
            rank, i = entry >> shift, entry & place
            if ranks[i] != rank:
                continue
            j, ids[i] = after[i], made[rank]
            ids[j] = ranks[j] = -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                ranks[i] = rank = rights[ids[i]](ids[j], -1)
                if rank >= 0:
                    push(queue, rank << shift | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rights[ids[h]](ids[i], -1)
                if rank >= 0:
                    push(queue, rank << shift | h)
        return [number for number in ids if number >= 0]

    def piece_ids(self, piece: str) -> bytes:
        return array("I", self.merge(piece.encode())).tobytes()

    def special(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for token in self.added_tokens.finditer(text) if self.added else ():
            parts += [self.of_stretches(text[at : token.start()]), [self.added[token[0]]]]
            at = token.end()
        return np.concatenate([*parts, self.of_stretches(text[at:])]).astype(np.uint32)

    def encode_joined(self, text: str) -> str:
        """The ids of a text in decimal, joined by commas."""
        return ",".join(map(str, self.encode(text)))

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def coded(self, texts: pa.StringArray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of each text, none of which is null: the number of its ids, these in decimal
        joined by commas, and the bytes of their strings, one after another."""
        ids = self.encode_all(texts)
        sizes = np.array([len(found) for found in ids], np.int64)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        flat = pa.array(np.concatenate(ids))
        joined = [
            pc.binary_join(pa.ListArray.from_arrays(ends, of_id.take(flat)), pa.scalar(between, of_id.type))
            for of_id, between in ((self._decimals, ","), (self._bytes, b""))
        ]
        return sizes, *joined

    def decode_joined(self, joined: str) -> str:
        """Text of ids in decimal; bytes that are no UTF-8 become U+FFFD."""
        if not joined:
            return ""
        return b"".join(map(self.strings.__getitem__, joined.split(","))).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        return self.decode_joined(",".join(map(str, ids)))


def load_bpe(spark: SparkSession, path: str) -> ByteBpe:
    """A byte-level BPE tokenizer from a tokenizers file. Spark reads the file if the
    path names a file system, else the driver does."""
    if "://" in path:
        text = spark.read.text(path, wholetext=True).first()["value"]
    else:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    parts = json.loads(text)
    model = parts["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    added = {token["content"]: token["id"] for token in parts["added_tokens"]}
    return ByteBpe(model["vocab"], merges, added)


CODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def token_ids(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, ids): the ids of each whole text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in portions(batch, "text"):
                ids = bpe.encode_all(pc.fill_null(part["text"], ""))
                lists = pa.array([found.astype(np.int32) for found in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, ids array<int>"
    )


def coded(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``: each whole
    text encoded, then decoded from its ids.

    Null and empty texts have no tokens and decode to the empty text. Repeated rows
    come back repeated, a null doc_id stays null, an empty table gives no rows; other
    columns than doc_id and text are not read. The string of an added token in a text
    is that token."""

    def digest(text: bytes) -> str:
        return sha256(text).hexdigest()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in portions(batch, "text"):
                sizes, joined, decoded = bpe.coded(pc.fill_null(part["text"], ""))
                ids_sha256 = [digest(ids.encode()) for ids in joined.to_pylist()]
                # Bytes that are no UTF-8 become U+FFFD.
                texts = [digest(found.decode("utf-8", "replace").encode()) for found in decoded.to_pylist()]
                columns = [pa.array(sizes), pa.array(ids_sha256), pa.array(texts)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], ["doc_id", *CODED.names])
        # The worker may stand idle beside others.
        bpe.forget()
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, T.StructType([T.StructField("doc_id", T.LongType()), *CODED])
    )
