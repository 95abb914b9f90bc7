from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
import zstandard

from opine.llm import token_files as t
from opine.llm.queries import vocabulary_path
from opine.session import new_folder, qualified


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def file_of(documents, width=2):
    out = io.BytesIO()
    writer = t.TokenFileWriter(out, width)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, dtype=f"<u{width}").tobytes())
    writer.finish()
    return out.getvalue()


def whole(tokenizer, rows):
    """What the contract asks for, from one pass over sorted rows."""
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_round_trip_and_random_access(width):
    documents = [(7, [1, 2, 3]), (None, []), (-9, list(range(5000))), (7, [65535])]
    read = t.TokenFile(Source(file_of(documents, width)))
    assert read.doc_ids == [7, None, -9, 7]
    for k in (2, 0, 3, 1):
        assert read.ids(k).tolist() == documents[k][1] and read.n_ids(k) == len(documents[k][1])


def test_no_documents():
    assert len(t.TokenFile(Source(file_of([])))) == 0


def test_any_zstandard_reader_can_read_it():
    raw = file_of([(1, [5, 6]), (2, [7])])
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as reader:
        assert reader.read().startswith(np.array([5, 6, 7], dtype="<u2").tobytes())


def test_damage_is_noticed():
    raw = file_of([(1, list(range(300))), (2, [7])])
    for at in (20, len(raw) - 1, len(raw) - 20):
        broken = bytearray(raw)
        broken[at] ^= 0xFF
        with pytest.raises(ValueError):
            read = t.TokenFile(Source(bytes(broken)))
            [read.ids(k) for k in range(len(read))]
    with pytest.raises(ValueError):
        t.TokenFile(Source(b"short"))


def test_one_damaged_document_leaves_the_others():
    raw = bytearray(file_of([(1, list(range(300))), (2, [7])]))
    raw[20] ^= 0xFF
    read = t.TokenFile(Source(bytes(raw)))
    assert read.ids(1).tolist() == [7]
    with pytest.raises(ValueError):
        read.ids(0)


def test_pieces_encode_as_the_whole_text(spark, tokenizer, documents, monkeypatch):
    texts = [r.text or "" for r in documents.select("text").collect()]
    texts += ["a<|endoftext|> b <|startoftext|>c", "tab\tand nbsp\x1c é É don't  I'LL", "x" * 300, "\n \n", "中文 字 ١٢٣ ½", "ÀÉ, ÑÜß. ÷× İı ſ K Ω", "a.. b.c ,d"]
    monkeypatch.setattr(t, "REMEMBERED", 500)  # forgets now and then
    encoder = t.Encoder(vocabulary_path())
    found = [i for at in range(0, len(texts), 7) for i in encoder.encode(texts[at : at + 7])]
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, dtype="<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_given_table(spark, tokenizer, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    assert sorted(map(tuple, t.write_and_read(documents, vocabulary_path()).collect())) == whole(tokenizer, rows)


def test_odd_rows(spark, tokenizer, odd):
    found = [tuple(r) for r in t.write_and_read(odd, vocabulary_path()).orderBy("start").collect()]
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert [r[0] for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:], strict=False)) and found[0][1] == 0
    expected = whole(tokenizer, rows)
    assert sorted((str(r[0]), r[2], r[3]) for r in found) == sorted((str(r[0]), r[2], r[3]) for r in expected)


def test_no_rows(spark, nothing):
    assert t.write_and_read(nothing, vocabulary_path()).collect() == []


def test_files_are_rolled_and_the_order_stays(spark, tokenizer, documents):
    folder = qualified(spark, new_folder(spark, "rolled"))
    manifest = t.write(documents, folder, vocabulary_path(), file_bytes=20_000)
    files = manifest.orderBy("shard", "part").collect()
    assert len(files) > spark.sparkContext.defaultParallelism and max(f.part for f in files) > 0
    longest = max(r.n for r in documents.selectExpr("length(text) AS n").collect())
    assert all(2 * f.tokens <= 20_000 + 2 * longest for f in files)
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    assert sorted(map(tuple, t.read(manifest, folder).collect())) == whole(tokenizer, rows)


def test_folders_without_a_scheme_are_completed(spark):
    """Else a worker would take them for its own disk, whatever the cluster's file system is."""
    assert qualified(spark, "/some/folder") == "file:///some/folder"
    assert qualified(spark, "file:/some/folder") == "file:///some/folder"


def test_tasks_of_a_worker_share_what_they_learnt():
    assert t.encoder_of(vocabulary_path()) is t.encoder_of(vocabulary_path())


def test_forgotten_words_are_kept_once_more(monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 8)
    encoder = t.Encoder(vocabulary_path())
    for n in range(50):
        encoder.encode([f"always word{n} other{n} third{n} fourth{n}"])
        assert len(encoder.known) < 12 and len(encoder.known.older) < 12
        assert not getattr(encoder.known.older, "older", None)
