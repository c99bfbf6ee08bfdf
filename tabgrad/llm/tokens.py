"""Token ids of documents as framed binary records, with a separate offset index.

A record is ``length`` (8 bytes), its masked checksum (4), the payload, and the payload's masked
checksum (4), all little-endian. The payload is a flag whether there is an id (1 byte), the
document's id (8) and the token ids, 2 bytes each if the vocabulary fits them, else 4. The index
file beside each data file holds one offset of 8 bytes per record, so a reader can take records in
any order without scanning.

Documents are sorted by id with a range shuffle, and each task encodes its run and writes it to data
files of about ``file_bytes`` with an index each; a file ends with the record that fills it. Files have a new name in every attempt, and the manifest, a Parquet table that
Spark commits whole, lists those of the attempts that counted. So a lost executor costs its tasks
only, and readers never see half a file. Files are written through ``pyarrow.fs``, so the folder
may be in any store with such a URI that the executors reach.

Defined results: null texts are empty and hold only the end id. Ties of ``doc_id`` go by a hash of
the text; documents without an id come first. An empty table gives an empty manifest. Other columns
are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabgrad.sources.store import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
_LENGTH, _CHECK, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<?q")
FILE_BYTES = 256 << 20
_READ = 4096  # records that a reader hands on at once
_CACHED, _RUN = 600_000, 100_000  # entries remembered twice over; pieces looked up at once


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def masked(checksum: int) -> int:
    """A checksum that may itself be stored among checked bytes."""
    return (((checksum >> 15) | (checksum << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join(
        (length, _CHECK.pack(masked(zlib.crc32(length))), payload, _CHECK.pack(masked(zlib.crc32(payload))))
    )


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies show for a byte: itself if it prints, else from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + n for n, b in enumerate(hidden)}


_BYTES = _byte_letters()


class _Recent(dict):
    """What was used of late: at most twice ``_CACHED`` entries, the older half forgotten at a time."""

    old: dict = {}

    def __missing__(self, key: str) -> bytes | None:
        found = self.old.get(key)
        if found is not None:
            self[key] = found
        return found

    def make_room(self, n: int) -> None:
        if len(self) + n > _CACHED:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Encodes whole texts with the tokenizers library, remembering the ids of what recurs.

    The byte-level pre-tokenizer always breaks between a character that is no white space and a
    space after it, and looks at nothing further back. So a text may be cut there, and equal pieces
    have equal ids wherever they stand. A new piece is cut once more, between a letter and an ASCII
    mark or line end, and around a single line end, unless it holds an added token. What is letters
    only is one pre-token and goes to the library's model as such.
    """

    _LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    _ODD = re.compile(r" (?<=\s )")
    _INNER = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-@\[-`{-~\n])|(?<=[!-~])(?=\n)|(?<=[!-~]\n)(?=[A-Za-zÀ-ÖØ-öø-ÿ])")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._check_shape()
        self.dtype = np.dtype("<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2")
        self.code = self.dtype.char  # ids are packed in the machine's order, which is little-endian
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(" " in token for token in self.added):
            raise ValueError("an added token with a space in it could be cut")
        self.model = self.tokenizer.model
        self.spaced = _Recent()  # ids of a space and the key
        self.plain = _Recent()  # ids of the key

    def _check_shape(self) -> None:
        """Only texts of this kind of tokenizer may be cut as above."""
        shape = json.loads(self.tokenizer.to_str())
        cuts = shape["pre_tokenizer"] or {}
        plain = cuts.get("type") == "ByteLevel" and not cuts.get("add_prefix_space") and cuts.get("use_regex", True)
        if not plain or shape["normalizer"] is not None or shape["model"].get("type") != "BPE" or shape["model"].get("dropout"):
            raise ValueError("needs a byte-level BPE tokenizer without normalizer, prefix space and dropout")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in shape["added_tokens"]):
            raise ValueError("an added token that takes white space along could be cut")

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text, without the space that begins all but the first."""
        cut = text.split(" ")
        if not self._ODD.search(text):
            return cut
        joined = [cut[0]]
        for piece in cut[1:]:
            if not joined[-1] or joined[-1][-1].isspace():
                joined[-1] += " " + piece
            else:
                joined.append(piece)
        return joined

    def _inner(self, piece: str) -> list[str]:
        if piece.isalpha() or any(a in piece for a in self.added):
            return [piece]
        return self._INNER.split(piece)

    def _add(self, known: _Recent, texts: set[str], space: str) -> None:
        other = []
        for text in texts:
            if self._LETTERS.fullmatch(text):
                shown = (space + text).encode().decode("latin-1").translate(_BYTES)
                known[text] = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
            else:
                other.append(text)
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast([space + t for t in some], add_special_tokens=False)
            known.update((t, array(self.code, e.ids).tobytes()) for t, e in zip(some, encoded))

    def _learn(self, pieces: set[str]) -> None:
        """Make ``pieces`` known."""
        new = {p for p in pieces if self.spaced[p] is None}
        cut = {p: parts for p in new if len(parts := self._inner(p)) > 1}
        heads = {parts[0] for parts in cut.values()}
        rests = {x for parts in cut.values() for x in parts[1:]}
        self._add(self.spaced, (new - cut.keys()) | {h for h in heads if self.spaced[h] is None}, " ")
        self._add(self.plain, {r for r in rests if self.plain[r] is None}, "")
        for piece, (head, *rest) in cut.items():
            self.spaced[piece] = b"".join([self.spaced[head], *[self.plain[r] for r in rest]])

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, packed."""
        first, *cut = self._cut(text)
        self.plain.make_room(2 * min(len(cut), _RUN) + 1)
        if self.plain[first] is None:
            self._add(self.plain, {first}, "")
        out = [self.plain[first]]
        for at in range(0, len(cut), _RUN):
            run = cut[at : at + _RUN]
            ids = list(map(self.spaced.get, run))
            if None in ids:
                self.spaced.make_room(2 * len(run))
                self.plain.make_room(2 * len(run))
                self._learn({p for p, i in zip(run, ids) if i is None})
                ids = [self.spaced[p] if i is None else i for p, i in zip(run, ids)]
            out.extend(ids)
        return b"".join(out)


@cache
def _encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


_MANIFEST = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("width", pa.int32())]
)


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Encode a sorted run of documents into data files with an index each; a manifest row per file."""
    rows = ((part, i, t) for b in batches for part, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)))
    encoder, store = None, None
    following = next(rows, None)
    seq = 0
    while following is not None:
        if encoder is None:
            encoder = _encoder(path)
            end = np.array([end_id], encoder.dtype).tobytes()
            store, root = pafs.FileSystem.from_uri(folder)
        name, part = uuid.uuid4().hex, following[0]
        n_records = n_tokens = at = 0
        with store.open_output_stream(f"{root}/{name}.rec") as out, store.open_output_stream(f"{root}/{name}.idx") as index:
            while following is not None and at < file_bytes:
                _, doc_id, text = following
                ids = encoder.encode(text.as_py() or "") + end
                record = frame(_HEAD.pack(doc_id is not None, doc_id or 0) + ids)
                out.write(record)
                index.write(_LENGTH.pack(at))
                n_records += 1
                at += len(record)
                n_tokens += len(ids) // encoder.dtype.itemsize
                following = next(rows, None)
        row = {"part": part, "seq": seq, "file": name, "n_records": n_records, "n_tokens": n_tokens, "n_bytes": at, "width": encoder.dtype.itemsize}
        yield pa.RecordBatch.from_pylist([row], schema=_MANIFEST)
        seq += 1


def _uri(folder: str) -> str:
    """A URI for pyarrow: Hadoop also takes plain paths, and ``file:`` with one slash."""
    if folder.startswith("file:"):
        return "file://" + re.sub("^file:/+", "/", folder)
    return folder if "://" in folder else "file://" + os.path.abspath(folder)


def write_tokens(
    documents: DataFrame,
    folder: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write the ids of all documents in ascending ``key`` order; returns the folder."""
    if file_bytes < 1:
        raise ValueError("file_bytes is at least 1")
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    rows = documents.select(F.col(key).cast("bigint").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text")).repartitionByRange("_id", "_tie")
    runs = rows.sortWithinPartitions("_id", "_tie").select(F.spark_partition_id().alias("_part"), "_id", "_text")
    data = f"{_uri(folder)}/data"
    store, root = pafs.FileSystem.from_uri(data)
    store.create_dir(root, recursive=True)
    schema = "part int, seq int, file string, n_records bigint, n_tokens bigint, n_bytes bigint, width int"
    written = runs.mapInArrow(
        partial(_write, folder=data, path=tokenizer or tokenizer_path(), end_id=end_id, file_bytes=file_bytes), schema
    )
    written.write.parquet(f"{folder}/manifest")
    return folder


def read_records(store, path: str, offsets: list[int] | None = None) -> Iterator[bytes]:
    """Checked payloads of a data file: all in order, or those at ``offsets`` in the order given."""

    def one(source) -> bytes | None:
        head = source.read(12)
        if not head:
            return None
        length, check = head[:8], _CHECK.unpack(head[8:])[0] if len(head) == 12 else None
        if check != masked(zlib.crc32(length)):
            raise ValueError(f"{path}: a record's length is damaged")
        payload = source.read(_LENGTH.unpack(length)[0])
        tail = source.read(4)
        if len(tail) != 4 or _CHECK.unpack(tail)[0] != masked(zlib.crc32(payload)):
            raise ValueError(f"{path}: a record is damaged")
        return payload

    if offsets is None:
        with store.open_input_stream(path, buffer_size=1 << 20) as source:
            while (payload := one(source)) is not None:
                yield payload
    else:
        with store.open_input_file(path) as source:
            for at in offsets:
                source.seek(at)
                yield one(source)


def read_index(store, path: str) -> np.ndarray:
    with store.open_input_stream(path) as source:
        return np.frombuffer(source.read(), "<u8")


def unpack(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    """The document's id, and its token ids as unsigned 32-bit integers."""
    known, doc_id = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)
    return doc_id if known else None, ids.astype("<u4")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = pafs.FileSystem.from_uri(folder)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for row in batch.to_pylist():
            start = n_records = 0
            records = read_records(store, f"{root}/{row['file']}.rec")
            while some := list(islice(records, _READ)):
                out = []
                for payload in some:
                    doc_id, ids = unpack(payload, row["width"])
                    out.append((doc_id, row["before"] + start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                n_records += len(out)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
            if n_records != row["n_records"] or start != row["n_tokens"]:
                raise ValueError(f"{row['file']}: records are missing")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Read every file back: ``doc_id, start, n_tokens, ids_crc32`` per document."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    # One row per file, which takes along how many ids stand before it.
    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return files.repartition(max(1, manifest.count())).mapInArrow(
        partial(_read, folder=f"{_uri(folder)}/data"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
