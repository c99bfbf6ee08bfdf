import json

import pytest
from pyspark.sql import functions as F

from tabgrad.functions import densify, dot_product
from tabgrad.operators import codec
from tabgrad.schema import FEATURES, LABELS, conform, key_violations, training_input_violations
from tabgrad.sources import read_features, read_labels, read_params

FEATURE_DDL = "sample_id bigint, idx int, value double"


def test_decode_reads_json_and_arrays(frame, rows):
    text = frame([(1, "[1.0, 2.5]"), (2, "[]"), (3, "oops"), (4, "[null, 3]")], "k int, v string")
    decoded = codec.decode_vector(text, ["k"], "v")
    assert rows(decoded) == [(1, 0, 1.0), (1, 1, 2.5), (4, 0, None), (4, 1, 3.0)]
    arrays = frame([(1, [1.0, 2.5])], "k int, v array<double>")
    assert rows(codec.decode_vector(arrays, ["k"], "v")) == [(1, 0, 1.0), (1, 1, 2.5)]
    assert rows(codec.malformed_vectors(text, ["k"], "v")) == [(2,), (3,)]


def test_encode_orders_by_index_and_keeps_nulls(frame):
    long = frame([(1, 2, 3.0), (1, 0, 1.0), (1, 1, None)], FEATURE_DDL)
    row = codec.encode_vector(long, ["sample_id"], as_json=True).first()
    assert json.loads(row["vector"]) == [1.0, None, 3.0]


def test_pixels_to_array_fills_gaps_in_place(frame, rows):
    long = frame([(1, 3, 9.0), (1, 0, 1.0), (2, 1, 5.0), (2, 7, 8.0), (3, 1, 2.0), (3, 1, 4.0)], FEATURE_DDL)
    expected = [(1, [1.0, 0.0, 0.0, 9.0]), (2, [0.0, 5.0, 0.0, 0.0]), (3, [0.0, 6.0, 0.0, 0.0])]
    assert rows(codec.pixels_to_array(long, 4)) == expected


def test_decode_inverts_encode(frame, rows):
    data = [(s, i, s * 1.5 + i) for s in range(3) for i in range(5)]
    long = frame(data, FEATURE_DDL)
    for as_json in (False, True):
        vectors = codec.encode_vector(long, ["sample_id"], as_json=as_json)
        assert rows(codec.decode_vector(vectors, ["sample_id"], "vector")) == sorted(data, key=repr)


def test_weights_round_trip(frame, rows):
    weights = frame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "output_idx int, weights array<double>")
    assert rows(codec.collect_weights(codec.explode_weights(weights))) == rows(weights)


def test_densify_null_fill_and_dot_product(frame):
    df = frame([([(1, 2.0)],)], "e array<struct<idx:int,value:double>>")
    assert df.select(densify(F.col("e"), 3, fill=None)).first()[0] == [None, 2.0, None]
    pair = frame([([1.0, None, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    assert pair.select(dot_product(F.col("a"), F.col("b"))).first()[0] == 22.0


def test_typed_readers(spark, tmp_path, rows):
    (tmp_path / "f.csv").write_text("sample_id,idx,value\n1,0,0.5\n1,1,-1\n")
    assert rows(read_features(spark, str(tmp_path / "f.csv"), "csv")) == [(1, 0, 0.5), (1, 1, -1.0)]
    (tmp_path / "l.json").write_text('{"sample_id": 1, "true_label": 3}\n')
    assert rows(read_labels(spark, str(tmp_path / "l.json"), "json")) == [(1, 3)]
    spark.range(2).selectExpr(
        "1 as layer", "id as output_idx", "0L as input_idx", "cast(id as float) as w", "'x' as extra"
    ).write.parquet(str(tmp_path / "p"))
    assert rows(read_params(spark, str(tmp_path / "p"))) == [(1, 0, 0, 0.0), (1, 1, 0, 1.0)]


def test_conform_reports_missing_columns(frame):
    with pytest.raises(ValueError, match="true_label"):
        conform(frame([(1,)], "sample_id int"), LABELS)
    assert conform(frame([(1, 0, 1)], "sample_id int, idx int, value int"), FEATURES).schema == FEATURES


def test_violations(frame, rows):
    biases = frame([(1, 0, 0.5), (1, 0, 0.5), (1, None, 1.0)], "layer int, output_idx int, b double")
    assert rows(key_violations(biases, ["layer", "output_idx"])) == [(1, 0, 2), (1, None, 1)]
    features = frame([(s, 0, 1.0) for s in (1, 2, 3, 4)], FEATURE_DDL)
    labels = frame([(1, 0), (2, 0), (2, 1), (3, 9), (5, 1)], "sample_id bigint, true_label int")
    assert rows(training_input_violations(features, labels, 3)) == [
        (2, "repeated label"),
        (3, "class out of range"),
        (4, "no label"),
        (5, "no features"),
    ]
