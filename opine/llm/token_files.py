"""Token ids as files of independent zstandard frames with a trailing seek table.

A file holds, in this order:

- one zstandard frame for each document: its ids, little-endian, unsigned, 2 or 4 bytes each; with zstandard's
  own content checksum;
- one frame with the directory: b"TIDS", the bytes of an id, the number of documents (unsigned 64 bits), a byte
  for each document that is 1 where its doc_id is null, and the doc_ids (signed 64 bits);
- a skippable frame in zstandard's public seekable format: for each frame its compressed size, its size and the
  low 32 bits of the XXH64 of its content; then the number of frames, a descriptor and a magic number.

Any zstandard tool can decompress such a file. A reader needs the tail, the directory, and the frames of the
documents it was asked for.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opine.llm.common import text_or_empty
from opine.session import new_folder, qualified, stage

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER, HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")

DIRECTORY_MAGIC = b"TIDS"
DIRECTORY_HEAD = struct.Struct("<4sBQ")

LEVEL = 3
END_ID = 1
# Encoded pieces, and lower-case words, that a task remembers, and the longest piece it does (about 200 bytes each).
REMEMBERED, LONGEST_REMEMBERED = 800_000, 48


# --- the file format -------------------------------------------------------------------


class TokenFileWriter:
    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.entries: list[bytes] = []
        self.doc_ids: list[int | None] = []

    def _frame(self, content: bytes) -> None:
        frame = self.compressor.compress(content)
        self.out.write(frame)
        self.entries.append(ENTRY.pack(len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._frame(ids)
        self.doc_ids.append(doc_id)

    def finish(self) -> None:
        nulls = bytes(d is None for d in self.doc_ids)
        numbers = np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes()
        self._frame(DIRECTORY_HEAD.pack(DIRECTORY_MAGIC, self.width, len(self.doc_ids)) + nulls + numbers)
        table = b"".join(self.entries) + FOOTER.pack(len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE_MAGIC, len(table)) + table)


class TokenFile:
    """Random access to a file's documents. `source` can seek and read; damaged parts raise ValueError."""

    def __init__(self, source):
        self.source = source
        self.decompressor = zstandard.ZstdDecompressor()
        size = source.size()
        frames, descriptor, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != WITH_CHECKSUMS:
            raise ValueError("not a token file: no seek table")
        length = frames * ENTRY.size + FOOTER.size
        if HEADER.unpack(self._read(size - length - HEADER.size, HEADER.size)) != (SKIPPABLE_MAGIC, length):
            raise ValueError("damaged seek table")
        table = np.frombuffer(self._read(size - length, frames * ENTRY.size), dtype="<u4").reshape(frames, 3)
        self.sizes, self.lengths, self.checks = (table[:, k].astype(np.int64) for k in range(3))
        self.offsets = np.cumsum(self.sizes) - self.sizes
        directory = self._content(frames - 1)
        magic, self.width, count = DIRECTORY_HEAD.unpack_from(directory)
        if magic != DIRECTORY_MAGIC or count != frames - 1:
            raise ValueError("damaged directory")
        nulls = directory[DIRECTORY_HEAD.size : DIRECTORY_HEAD.size + count]
        numbers = np.frombuffer(directory, dtype="<i8", offset=DIRECTORY_HEAD.size + count)
        self.doc_ids = [None if null else int(n) for null, n in zip(nulls, numbers, strict=True)]

    def _read(self, at: int, length: int) -> bytes:
        if at < 0:
            raise ValueError("not a token file: too short")
        self.source.seek(at)
        return self.source.read(length)

    def _content(self, frame: int) -> bytes:
        try:
            stored = self._read(int(self.offsets[frame]), int(self.sizes[frame]))
            content = self.decompressor.decompress(stored, allow_extra_data=False)
        except zstandard.ZstdError as damage:
            raise ValueError(f"damaged frame {frame}") from damage
        if len(content) != self.lengths[frame] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[frame]:
            raise ValueError(f"damaged frame {frame}")
        return content

    def __len__(self) -> int:
        return len(self.doc_ids)

    def n_ids(self, document: int) -> int:
        """Known from the seek table: nothing is decompressed."""
        return int(self.lengths[document]) // self.width

    def ids(self, document: int) -> np.ndarray:
        """The ids of one document, as unsigned 32-bit integers; decompresses its frame only."""
        return np.frombuffer(self._content(document), dtype=f"<u{self.width}").astype("<u4")


# --- encoding --------------------------------------------------------------------------


# A word of letters of Latin-1 with signs of ASCII after it, but no apostrophe: what texts mostly consist of.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
PROBES = ("a", "the", "thing", "queño", "straße", "ÿàé", "internationalization", "zzxqj")


def _byte_character(byte: int) -> str:
    """Byte-level vocabularies write a byte as itself where Latin-1 prints it, else as the next free character."""
    unprinted = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return chr(256 + unprinted.index(byte)) if byte in unprinted else chr(byte)


_BYTE_LEVEL = {c: "".join(map(_byte_character, chr(c).encode())) for c in range(0xDF, 0x100)}


class _Pieces(dict):
    """Encoded pieces; one that is not there is taken from the older ones or encoded."""

    def __init__(self, encoder: Encoder, older: dict[str, bytes]):
        super().__init__()
        self.encoder, self.older = encoder, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encoder.piece(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = ids
        return ids


class Encoder:
    """Text to ids as bytes. Texts are cut at blanks and line ends, where the tokenizer cuts them too, and
    encoded pieces are remembered, because words come back. A plain word goes straight to the tokenizer's model
    in lower case, if that gives what the whole tokenizer gives; every other piece goes through all of it."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.known = _Pieces(self, {})
        self.lower: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        probes = [*PROBES, *map(str.upper, PROBES[:4])]
        self.has_plain_words = [self._encoded(p) for p in probes] == [self._plain(p) for p in (*PROBES, *PROBES[:4])]

    def _bytes(self, ids: list[int]) -> bytes:
        if sys.byteorder == "little":
            return array(self.code, ids).tobytes()
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _encoded(self, piece: str) -> bytes:
        return self._bytes(self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids)

    def _plain(self, lower: str) -> bytes:
        written = lower if lower.isascii() else lower.translate(_BYTE_LEVEL)
        return self._bytes([token.id for token in self.model.tokenize(written)])

    def piece(self, piece: str) -> bytes:
        """The ids of one piece, by the shorter way where there is one."""
        match = PLAIN_WORD.fullmatch(piece) if self.has_plain_words and len(piece) <= LONGEST_REMEMBERED else None
        if match is None:
            return self._encoded(piece)
        lower, signs = match[1].lower(), match[2]
        ids = self.lower.get(lower)
        if ids is None:
            ids = self.lower[lower] = self._plain(lower)
        if signs:
            if signs not in self.signs:
                self.signs[signs] = self._encoded(signs)
            ids += self.signs[signs]
        return ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        # What is not met again while so many others are is forgotten.
        if len(self.known) > REMEMBERED // 2:
            self.known.older = {}
            self.known = _Pieces(self, self.known)
        if len(self.lower) + len(self.signs) > REMEMBERED:
            self.lower, self.signs = {}, {}
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, text.replace("\n", " ").split(" "))) for text in texts]


# One for each vocabulary in a worker process: the next task there knows the words of the last.
_encoders: dict[str, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


# --- over documents --------------------------------------------------------------------

MANIFEST = "shard int, part int, path string, documents bigint, tokens bigint"
BATCH = 500
# A file is closed once its documents' ids have so many bytes.
FILE_BYTES = 256 * 1024 * 1024


def write(documents: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every document and write files in ascending doc_id order; returns their manifest.

    shard, part, path, documents, tokens: one row for each file, in the order of doc_id by shard and part. Rows are
    dealt by ranges of doc_id (nulls first, ties by the text's hash); each task writes files under names of its own
    attempt, each of at most `file_bytes` of ids and one document more, and only files that the manifest lists count;
    what a lost executor left behind is not listed. `folder` is any address, with its scheme, that pyarrow's file
    systems know and that all executors share.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, writer, part, size = encoder_of(vocabulary), None, 0, 0
        system, base = fs.FileSystem.from_uri(folder)
        end = np.array([end_id], dtype=f"<u{encoder.width}").tobytes()
        shard = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex

        def closed() -> pd.DataFrame:
            writer.finish()
            writer.out.close()
            row = {"shard": shard, "part": part, "path": path, "documents": len(writer.doc_ids), "tokens": size // encoder.width}
            return pd.DataFrame([row])

        for batch in batches:
            for at in range(0, len(batch), BATCH):
                some = batch.iloc[at : at + BATCH]
                for doc_id, ids in zip(some["doc_id"], encoder.encode(some["text"].tolist()), strict=True):
                    if writer is None:
                        system.create_dir(base, recursive=True)
                        path = f"{base}/{shard:06d}-{part:06d}-{attempt}.ids.zst"
                        writer = TokenFileWriter(system.open_output_stream(path, compression=None), encoder.width)
                    writer.add(None if pd.isna(doc_id) else int(doc_id), ids + end)
                    size += len(ids) + encoder.width
                    if size >= file_bytes:
                        yield closed()
                        writer, part, size = None, part + 1, 0
        if writer is not None:
            yield closed()

    text = text_or_empty()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # doc_id travels as a decimal: a bigint column with nulls would come to pandas as floats.
    sent = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return stage(sent.mapInPandas(written, MANIFEST), "token-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files of a manifest."""
    placed = manifest.withColumn(
        "base",
        # One row for each file, not for each document.
        F.sum("tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("path", F.coalesce("base", F.lit(0)).alias("base"))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch["path"], batch["base"], strict=True):
                with system.open_input_file(path) as source:
                    tokens = TokenFile(source)
                    for first in range(0, len(tokens), BATCH):
                        part = range(first, min(first + BATCH, len(tokens)))
                        lengths = np.array([tokens.n_ids(k) for k in part], dtype=np.int64)
                        yield pd.DataFrame(
                            {
                                "doc_id": pd.array([tokens.doc_ids[k] for k in part], dtype="Int64"),
                                "start": start + np.cumsum(lengths) - lengths,
                                "n_tokens": lengths,
                                "ids_crc32": [zlib.crc32(tokens.ids(k).tobytes()) for k in part],
                            }
                        )
                        start += int(lengths.sum())

    files = max(1, manifest.count())
    return placed.repartition(files).mapInPandas(found, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Write token files to the shared folder, read them back: doc_id, start, n_tokens, ids_crc32.

    A row for each row of `documents`. A null or empty text is its end id alone. Rows may repeat: each is
    written; those of one doc_id follow each other. Null ids come first. Other columns are not read.
    """
    spark = documents.sparkSession
    folder = qualified(spark, new_folder(spark, "token-files"))
    return read(write(documents, folder, vocabulary), folder)
