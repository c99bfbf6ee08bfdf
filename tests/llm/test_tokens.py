"""Encoded ids against the library on whole texts, and an exact round trip through the files."""

from __future__ import annotations

import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from tabgrad.llm import tokens
from tabgrad.llm.queries import op6_token_id_binary_output

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def whole():
    library = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


def expected(rows: list[tuple], whole) -> list[tuple]:
    out, start = [], 0
    for key, text in sorted(rows):
        ids = [*whole(text), 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_matches_the_library(spark, table, whole):
    rows = [(r["doc_id"], r["text"]) for r in table("documents", SF)]
    found = op6_token_id_binary_output(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == expected(rows, whole)


def test_pieces_encode_like_whole_texts(whole, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHED", 60)
    monkeypatch.setattr(tokens, "_RUN", 7)
    encoder = tokens.Encoder(tokens.tokenizer_path())
    draw = random.Random(3)
    alphabet = ["a", "b", "Été", "ñ", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "it's", "12", ".", "|", "!!", " ", "　", "日本", "<|endoftext|>", "_", "\x00", "\U0001f600", "é", "\x1f", "-\n"]
    for _ in range(3000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == whole(text), repr(text)


def test_edge_cases_and_index(spark, whole, tmp_path):
    rows = [(3, "b c"), (1, None), (2, ""), (9, "long word " * 60_000), (-4, "é"), (3, "b c")]
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, part string, start int")
    folder = tokens.write_tokens(df, str(tmp_path / "out"))
    found = sorted(map(tuple, tokens.read_tokens(spark, folder).collect()))
    assert found == expected([(k, t or "") for k, t in rows], whole)
    store = pafs.LocalFileSystem()
    seen = []
    for row in spark.read.parquet(f"{folder}/manifest").collect():
        offsets = tokens.read_index(store, f"{folder}/data/{row.file}.idx")
        assert len(offsets) == row.n_records
        for payload in tokens.read_records(store, f"{folder}/data/{row.file}.rec", offsets[::-1].tolist()):
            seen.append(tokens.unpack(payload, row.width)[0])
    assert sorted(seen) == sorted(k for k, _ in rows)


def test_damage_is_found(spark, tmp_path):
    folder = tokens.write_tokens(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), str(tmp_path / "out"))
    name = spark.read.parquet(f"{folder}/manifest").first().file
    path = tmp_path / "out" / "data" / f"{name}.rec"
    data = bytearray(path.read_bytes())
    data[20] ^= 1
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        tokens.read_tokens(spark, folder).collect()


def test_missing_ids_come_first(spark, tmp_path):
    folder = tokens.write_tokens(spark.createDataFrame([(1, "a"), (None, "b")], "doc_id long, text string"), str(tmp_path / "out"))
    assert [(r.doc_id, r.start) for r in tokens.read_tokens(spark, folder).orderBy("start").collect()] == [(None, 0), (1, 2)]


def test_empty_table(spark, tmp_path):
    folder = tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "out"))
    assert tokens.read_tokens(spark, folder).collect() == []


def test_files_of_bounded_size(spark, tmp_path):
    rows = [(k, f"document {k} " * (k % 30)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    one = tokens.write_tokens(df, str(tmp_path / "one"))
    many = tokens.write_tokens(df, str(tmp_path / "many"), file_bytes=900)
    results = [sorted(map(tuple, tokens.read_tokens(spark, f).collect())) for f in (one, many)]
    assert results[0] == results[1] and [r[0] for r in results[0]] == list(range(300))
    files = spark.read.parquet(f"{many}/manifest").collect()
    # A file ends with the record that fills it.
    assert len(files) > 20 and all(f["n_bytes"] < 900 + 400 for f in files)
    with pytest.raises(ValueError):
        tokens.write_tokens(df, str(tmp_path / "none"), file_bytes=0)


def test_other_kinds_of_tokenizers_are_refused(tmp_path):
    shape = json.loads(Path(tokens.tokenizer_path()).read_text())
    prefixed = shape | {"pre_tokenizer": shape["pre_tokenizer"] | {"add_prefix_space": True}}
    for n, other in enumerate((prefixed, shape | {"normalizer": {"type": "Lowercase"}}, shape | {"pre_tokenizer": {"type": "Whitespace"}})):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(other))
        with pytest.raises(ValueError, match="byte-level"):
            tokens.Encoder(str(path))
