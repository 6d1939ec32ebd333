"""Token records: checksums, files, reads in order and shuffled, and the query."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ridestrata.llm import records, stretches
from ridestrata.llm.queries import QUERIES, with_library
from ridestrata.llm.records import Encoder, crc32c, framed, masked, shuffled_places, token_records, unframed

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(FILE)
    found.no_padding()
    found.no_truncation()
    return found


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert plain_crc32c(b"123456789") == 0xE3069283
    rng = random.Random(3)
    parts = [rng.randbytes(n) for n in (0, 1, 8, 9, 63, 64, 65, 128, 129, 5000)] + [b"123456789", b"\0" * 70]
    data, lengths = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    found = crc32c(data, np.cumsum(lengths) - lengths, lengths)
    assert found.tolist() == [plain_crc32c(p) for p in parts]
    assert int(masked(found)[10]) == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_frames_and_damage():
    ids = [np.array(x, np.int32) for x in ([], [1, 2], [70_000, 3], list(range(3000)))]
    data, lengths = framed(pa.array([5, None, -7, 1 << 60], pa.int64()), ids)
    places = np.cumsum(lengths) - lengths
    doc_ids, back = unframed(data, places)
    assert doc_ids == [5, None, -7, 1 << 60] and [x.tolist() for x in back] == [x.tolist() for x in ids]
    for at in (0, 9, int(places[1]) + 14, int(places[3]) + 700, len(data) - 1):
        wrong = bytearray(data)
        wrong[at] ^= 1
        with pytest.raises(ValueError):
            unframed(bytes(wrong), places)
    with pytest.raises(ValueError):
        unframed(data[:-5], places)


def test_shuffled_places_are_a_permutation():
    for count in (1, 2, 3, 10, 1000, 4097):
        for seed in (0, 1, 99):
            found = shuffled_places(count, seed, np.arange(count))
            assert sorted(found.tolist()) == list(range(count))
    assert shuffled_places(1000, 1, np.arange(1000)).tolist() != shuffled_places(1000, 2, np.arange(1000)).tolist()


def test_encoder_like_the_library(library):
    with open(FILE, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    assert encoder.by_pieces
    rng = random.Random(2)
    parts = [*"ab Zé\n\t\r  '’.,!?019½²中😀\x85\x1c\xa0　\0", "'s", "'LL", "<|endoftext|>", "<|", " the", "  ", "\n\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    even = [*"aZé’.,!?019½中😀\x1c", "'s", "the", "<|endoftext|>", "the,", "<|", "\n\n"]
    texts += [rng.choice([" ", "\n", " ", "\n\n"]).join(rng.choices(even, k=rng.randrange(12))) for _ in range(4000)]
    found = encoder.encode_all(pa.array(texts))
    for text, ids in zip(texts, found):
        assert ids.tolist() == encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert [ids.tolist() for ids in encoder.encode_all(pa.array(["", "a"]))] == [[], [64]]
    long = "abcdefghij" * 5000
    assert encoder.encode(long).tolist() == library.encode(long, add_special_tokens=False).ids


ODD = [(3, "three words here"), (None, "no id"), (1, None), (2, ""), (3, "three words here"), (3, "another"), (-4, "minus"), (9, "the long one " * 40_000)]


def test_records_of_odd_rows(spark, library, tmp_path):
    with_library(spark)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, start string, ids int")
    rows = token_records(docs, str(tmp_path / "a")).collect()
    texts = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [i for i, _ in texts]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(i), ids_of(library, t)) for i, t in ODD)
    assert [r["start"] for r in rows] == np.cumsum([0, *(len(r["ids"]) for r in rows)])[:-1].tolist()
    shuffled = records.read_records(spark, str(tmp_path / "a"), seed=5, block=3).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, rows)) and shuffled != rows
    empty = token_records(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "b"))
    assert empty.count() == 0 and records.read_records(spark, str(tmp_path / "b"), seed=1).count() == 0


def test_ids_without_a_tokenizer(spark, tmp_path):
    with_library(spark)
    rows = [(1, [5, 70_000]), (2, []), (None, [0])]
    path = str(tmp_path / "ids")
    records.write_records(spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1), path)
    assert [tuple(r) for r in records.read_records(spark, path).collect()] == [(1, 0, [5, 70_000]), (2, 2, []), (None, 2, [0])]


def test_files_not_in_the_manifest_do_not_count(spark, tmp_path):
    with_library(spark)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    path = tmp_path / "a"
    rows = token_records(docs, str(path)).collect()
    name = next(path.glob("*.records"))
    (path / "part-000000-dead.records").write_bytes(name.read_bytes()[:20])
    assert records.read_records(spark, str(path)).collect() == rows
    body = bytearray(name.read_bytes())
    body[30] ^= 255
    name.write_bytes(bytes(body))
    with pytest.raises(Exception, match="checksum"):
        records.read_records(spark, str(path)).collect()


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected, start = [], 0
    for row in sorted(docs):
        ids = ids_of(library, row["text"])
        expected.append((row["doc_id"], start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op13_token_records"](spark, SF).collect())) == expected


def test_rows_encoded_together_are_bounded(library, monkeypatch):
    with open(FILE, encoding="utf-8") as file:
        content = file.read()
    monkeypatch.setattr(stretches, "STRETCHES", 50)
    monkeypatch.setattr(Encoder, "pieces_kept", 20)
    rng = random.Random(5)
    words = ["the", "Éa", "ñdo,", "a%%%", "x's", "1a", "é!!", "²", "ªb", "ɐb", "中文", "a'", "and..."]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "b", "ly"]) for _ in range(3000)) for _ in range(600)] + [None, ""]
    rows = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    encoder, found = Encoder(content), []
    for part in stretches.portions(rows, "text"):
        assert part.num_rows <= stretches.ROWS_TOGETHER
        assert part.num_rows == 1 or sum(len((t or "").encode()) for t in part["text"].to_pylist()) <= stretches.BYTES_TOGETHER
        found += encoder.encode_all(part["text"].fill_null(""))
        assert len(encoder._words) <= 50 and len(encoder._older_words) <= 50 and len(encoder._known) <= 20
    assert len(found) == len(texts)
    for text, ids in list(zip(texts, found))[-40:]:
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_new_words_of_letters_go_to_the_model_as_they_are(library, monkeypatch):
    with open(FILE, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    mapped, piece_ids = [], encoder.piece_ids
    monkeypatch.setattr(encoder, "piece_ids", lambda piece: mapped.append(piece) or piece_ids(piece))
    texts = ["So fluxomat zorblings, don't é zorbling b2b", "So fluxomat", "a\nzorbling zorbling's x"]
    for text, ids in zip(texts, encoder.encode_all(pa.array(texts))):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert " fluxomat" not in mapped and " é" in mapped
