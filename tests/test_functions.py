"""Scalar functions against values worked out by hand or by plain Python."""

import hashlib

from pyspark.sql import functions as F

from corpuskit.functions import hashing as H
from corpuskit.functions import text as T
from corpuskit.operators.common import norm, not_blank


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()[0]


def test_slug_and_stem(spark):
    slug = {"  My File (2).JPG ": "my_file_2_.jpg", "__a__b__": "a_b", None: "", "é-x": "-x", "a  b": "a_b"}
    for k, v in slug.items():
        assert one(spark, k, T.slug) == v
    stem = {"Cat_real_copy": "cat", "cat_v12": "cat", "cat_mask_v2": "cat_mask", "_fake": "fake", "": "unknown", "a_fake_dup": "a", "realm": "realm"}
    for k, v in stem.items():
        assert one(spark, k, T.stem_id) == v


def test_hint_and_defaults(spark):
    for k, v in {" VAL ": "val", "": "seen", None: "seen", "  ": "seen"}.items():
        assert one(spark, k, T.split_hint) == v
    assert one(spark, "x1", lambda c: T.number_or(c, 1.0)) == 1.0
    assert one(spark, "2.5", lambda c: T.number_or(c, 1.0)) == 2.5
    assert one(spark, 3, T.text_or, "int") == "3"
    assert T.parse_list(" a, ,b ") == ["a", "b"] and T.parse_list(None) == []


def test_paths(spark):
    p = "/data/set/real//shard_1/./img.v2.jpg"
    assert one(spark, p, T.file_name) == "img.v2.jpg" and one(spark, p, T.file_stem) == "img.v2"
    assert one(spark, p, T.group_token) == "shard_1"
    assert one(spark, p, lambda c: T.group_token(c, 2)) == "real"
    assert one(spark, p, lambda c: T.group_token(c, 9)) == "img.v2"
    assert one(spark, p, lambda c: T.group_token(c, 0)) == "shard_1"
    assert one(spark, "img.jpg", T.source_of_path) == "unknown" and one(spark, "a/img.jpg", T.source_of_path) == "a"
    assert one(spark, ".hidden", T.file_stem) == ".hidden"


def test_family_groups(spark):
    df = spark.createDataFrame(
        [("FakeClue", "fakeclue_animal_real", "/x/a.jpg"), ("fakeclue", "other", "/m/fakeclue/v1/doc/a.jpg"), ("fakeclue", "other", "/m/a.jpg"), ("dragon", "d", "/m/prompt_7_v2.png"), (None, None, None)],
        "dataset string, name string, path string",
    )
    got = df.select(T.pair_group("dataset", "name", "path", "fakeclue"), T.prompt_group("dataset", "path", "dragon")).collect()
    assert [tuple(r) for r in got] == [("fakeclue:animal", ""), ("fakeclue:doc", ""), ("fakeclue:unknown", ""), ("", "dragon:prompt_7"), ("", "")]


def test_hashes(spark):
    text = "/a/b.jpg"
    digest = hashlib.md5(text.encode()).hexdigest()
    assert one(spark, text, lambda c: H.hash_bucket(c, 97)) == f"bucket_{int(digest, 16) % 97:03d}"
    assert one(spark, text, H.hash_offset) == int(digest[:8], 16)
    assert one(spark, text, H.seed_offset) == sum((i + 1) * ord(c) for i, c in enumerate(text)) % 100_003
    assert one(spark, "", H.seed_offset) == 0
    assert one(spark, "ffffffffffffffff", H.hash_to_long) == -1 and one(spark, "", H.hash_to_long) is None and one(spark, "xyz", H.hash_to_long) is None
    assert one(spark, "ff00", H.thumb_bytes) == [255, 0]


def test_comparisons(spark):
    df = spark.createDataFrame([(-1, 0, "00ff", "01fe", 4, 2), (None, 0, "", "01", None, 0)], "a bigint, b bigint, x string, y string, w int, h int")
    got = df.select(H.hamming(F.col("a"), F.col("b")), H.mean_difference(H.thumb_bytes("x"), H.thumb_bytes("y")), F.round(H.log_aspect("w", "h"), 4)).collect()
    assert tuple(got[0]) == (64, 1.0, 0.6931) and got[1][0] == 1 << 30 and got[1][1] == float("inf") and got[1][2] == 0.0
    v = spark.createDataFrame([([0.5, -1.0, 2.0] + [0.0] * 60 + [3.0],)], "v array<float>")
    assert v.select(H.sign_bits("v")).first()[0] == (0b101 | (1 << 63)) - (1 << 64)
    assert v.select(H.band(F.lit(0x1234).cast("bigint"), 1, 8)).first()[0] == 0x12


def test_norm(spark):
    assert one(spark, "\t A b ", norm) == "a b" and one(spark, None, norm) is None
    assert one(spark, "  ", not_blank) is False and one(spark, "x", not_blank) is True


def test_hint_spaces(spark):
    from corpuskit.functions.text import split_hint

    df = spark.createDataFrame([("\tUnseen \n",), (" \t",), (None,), ("Seen",)], "h string")
    assert [r[0] for r in df.select(split_hint("h")).collect()] == ["unseen", "seen", "seen", "seen"]
