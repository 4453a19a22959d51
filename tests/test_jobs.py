"""The commands one after the other over a small tree of pictures."""

import hashlib
import sys

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from corpuskit import cli
from corpuskit.functions.text import column_or, smooth_target
from corpuskit.jobs import build
from corpuskit.operators.summary import except_keys, union_first
from corpuskit.operators.weights import draw_epoch
from corpuskit.sources.images import encode_png
from corpuskit.sources.scoring import embed_rows


def smooth(rng):
    small = rng.integers(0, 255, (4, 4, 3)).astype(np.uint8)
    return np.kron(small, np.ones((10, 10, 1), np.uint8)).astype(np.uint8)


@pytest.fixture(scope="module")
def pool(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("pool"), np.random.default_rng(1)
    sources = []
    for name, label, hint in (("real_a", 0, "seen"), ("real_b", 0, "seen"), ("real_t", 0, "unseen"), ("gen_a", 1, "seen"), ("gen_b", 1, "seen"), ("gen_t", 1, "unseen")):
        d = root / name
        for i in range(12):
            (d / f"s{i % 4}").mkdir(parents=True, exist_ok=True)
            (d / f"s{i % 4}" / f"{name}_{i}.png").write_bytes(encode_png(smooth(rng)))
        copy = (d / "s0" / f"{name}_0.png").read_bytes()
        (d / "s1" / f"{name}_copy.png").write_bytes(copy)
        sources.append({"path": str(d), "label": label, "name": name, "generator": "real" if label == 0 else name, "split_hint": hint})
    (root / "gen_a" / "s0" / "broken.png").write_bytes(b"no picture")
    (root / "gen_b" / "s0" / "stolen.png").write_bytes((root / "real_b" / "s2" / "real_b_2.png").read_bytes())
    path = root / "manifest.yaml"
    path.write_text(yaml.safe_dump({"sources": sources}))
    return root, str(path)


def test_pipeline(spark, pool, tmp_path, rows):
    root, manifest = pool
    scan = build("scan", {"manifest": manifest, "output": f"{tmp_path}/index"}).run(spark)
    assert scan["rows"] == 80 and scan["label"] == {"1": 41, "0": 39}
    report = build("dedup", {"manifest": manifest, "out_dir": f"{tmp_path}/dedup"}).run(spark)
    assert report["summary"]["drop_reasons"]["label_conflict"] == 2 and report["summary"]["drop_reasons"]["read_error"] == 1
    assert report["summary"]["drop_reasons"]["duplicate_noncanonical"] >= 6
    clean = spark.read.parquet(f"{tmp_path}/dedup/clean_index")
    assert clean.count() == report["summary"]["clean_rows"] and clean.select("path").distinct().count() == clean.count()
    embed_rows(clean.select("path", "thumb8_hex"), lambda: lambda p: np.array([list(bytes.fromhex(t)) for t in p.thumb8_hex], float)).write.parquet(f"{tmp_path}/vectors")
    sem = build("semantic", {"clean_index": f"{tmp_path}/dedup/clean_index", "report": f"{tmp_path}/dedup/report.yaml", "vectors": f"{tmp_path}/vectors", "out_dir": f"{tmp_path}/sem", "min_clean": 5, "max_removed": 0.9, "tiers": [{"min_rows": 0, "cosine_threshold": 0.9, "topk": 8}]}).run(spark)
    assert sem["pairs"] > 0 and "real_a" in sem["focus_sources"] and 0 < sem["dropped"] < sem["rows"]
    full = spark.read.parquet(f"{tmp_path}/sem/full_index")
    assert full.filter("semantic_component_id LIKE 'sem:singleton:%'").count() > 0 and full.filter("tight_split_component_id IS NULL").count() == 0
    split_of = full.groupBy("split_component_id").agg(F.countDistinct("tight_split_component_id").alias("n"))
    assert split_of.filter("n > 1").count() == 0
    options = {"real_sources": ["real_b"], "fake_generators": ["gen_b"], "real_rows": 4, "fake_rows": 4, "rules": [{"min_rows": 0, "ratio": 0.2, "min_rows_out": 1, "cap_rows_out": 3}], "unit": "split_component_id"}
    tight = build("tight", {"input": f"{tmp_path}/dedup/clean_index", "out_dir": f"{tmp_path}/tight", "options": options}).run(spark)
    assert tight["overlap"]["train/val_seen"]["split_component_id"] == 0 and tight["splits"]["test"]["rows"] > 0
    compact = build("compact", {"input": f"{tmp_path}/dedup/clean_index", "out_dir": f"{tmp_path}/compact", "totals": [5, 2, 2, 3, 0]}).run(spark)
    assert compact["splits"]["train_stage1"]["rows"] == 10
    assert build("heldout", {"input": f"{tmp_path}/dedup/clean_index", "out_dir": f"{tmp_path}/held", "val_real": 4, "val_fake": 4}).run(spark)["splits"]["val"]["rows"] == 8
    assert build("single", {"input": f"{tmp_path}/dedup/clean_index", "out_dir": f"{tmp_path}/single", "train": [6, 6], "val": [2, 2]}).run(spark)["splits"]["train"]["rows"] == 12
    scored = clean.withColumn("score", F.pmod(F.xxhash64("path"), F.lit(1000)) / 1000.0)
    scored.write.parquet(f"{tmp_path}/scored")
    mined = build("mine", {"scored": f"{tmp_path}/scored", "buffer": f"{tmp_path}/buffer", "top": [5, 5, 5], "most": 12, "base_train": f"{tmp_path}/dedup/clean_index", "merged_train": f"{tmp_path}/merged"}).run(spark)
    assert mined["threshold"] == 0.5 and mined["mined"] == 15 and mined["buffer"] == 12
    result = build("evaluate", {"scored": f"{tmp_path}/scored", "output": f"{tmp_path}/metrics.yaml"}).run(spark)
    assert 0 <= result["auroc"] <= 1 and "recall@0.95" in result
    with pytest.raises(ValueError):
        build("scan", {"nope": 1})


def test_command_line(spark, pool, tmp_path, capsys):
    config = tmp_path / "c.yaml"
    config.write_text(yaml.safe_dump({"manifest": pool[1], "output": "nowhere"}))
    assert cli.main(["scan", str(config), f"output={tmp_path}/out"]) == 0
    assert "rows: 80" in capsys.readouterr().out
    assert cli.main(["unknown"]) == 2


def test_small_pieces(spark, rows):
    a = spark.createDataFrame([("/s/1", 1), (None, 2)], "path string, x int")
    b = spark.createDataFrame([("/s/1", 9, "e"), ("/s/2", 3, "f")], "path string, x int, more string")
    assert rows(union_first([a, b], "path")) == [("/s/1", 1, None), ("/s/2", 3, "f")]
    assert rows(except_keys(b, a, "path"), "path") == [("/s/2",)]
    assert rows(a.select(column_or(a, "source"), column_or(a, "x"), column_or(a, "other"), F.round(smooth_target("x", 0.2), 3))) == [("s", "1", "unknown", 0.9), ("unknown", "2", "unknown", 1.7)]
    ids = spark.createDataFrame([(i, f"s{i % 3}") for i in range(30)], "id bigint, source string")
    even = draw_epoch(ids, "id", "shuffle", 30, 1, world=2)
    assert len({r["id"] for r in even.collect()}) == 30
    one, two = (draw_epoch(ids, "id", "source_balanced", 40, 1, epoch=e).collect() for e in (0, 1))
    assert len(one) == 40 and [r["id"] for r in sorted(one)] != [r["id"] for r in sorted(two)]


def test_dedup_of_every_format(spark, tmp_path):
    from tests.test_sources import jvm_picture, laced_png

    d, rng = tmp_path / "pool" / "real_a", np.random.default_rng(2)
    d.mkdir(parents=True)
    for i, (name, kind) in enumerate((("a b+c%20.jpg", "jpg"), ("b.JPEG", "jpg"), ("c.bmp", "bmp"), ("named.png", "jpg"))):
        (tmp_path / f"{i}.png").write_bytes(encode_png(smooth(rng)))
        jvm_picture(spark, tmp_path / f"{i}.png", d / name, kind)
    (d / "copy.jpg").write_bytes((d / "b.JPEG").read_bytes())
    (d / "same_as_c.png").write_bytes((tmp_path / "2.png").read_bytes())
    (d / "laced.png").write_bytes(laced_png(smooth(rng).astype(int) * 257))
    (d / "cut.jpg").write_bytes((d / "b.JPEG").read_bytes()[:60])
    (d / "other.webp").write_bytes(b"RIFF")
    manifest = tmp_path / "m.yaml"
    manifest.write_text(yaml.safe_dump({"sources": [{"path": str(d), "label": 0, "name": "real_a"}]}))
    report = build("dedup", {"manifest": str(manifest), "out_dir": f"{tmp_path}/out"}).run(spark)
    assert report["summary"]["rows"] == 9 and report["summary"]["unread_by_ending"] == {"jpg": 1, "webp": 1}
    assert report["summary"]["drop_reasons"] == {"": 5, "duplicate_noncanonical": 2, "read_error": 2}
    index = {r["filename"]: r for r in spark.read.parquet(f"{tmp_path}/out/scan_index").collect()}
    assert index["b.JPEG"]["raw_sha1"] == hashlib.sha1((d / "b.JPEG").read_bytes()).hexdigest()
    assert index["c.bmp"]["pixel_sha1"] == index["same_as_c.png"]["pixel_sha1"] != "" and index["a b+c%20.jpg"]["width"] == 40
    (tmp_path / "own_webp.py").write_text("import numpy as np\n\n\ndef read(data):\n    assert data[:4] == b'RIFF'\n    return np.full((9, 9, 3), 7, np.uint8)\n")
    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "own_webp.py"))
    report = build("dedup", {"manifest": str(manifest), "out_dir": f"{tmp_path}/own", "decoder": "own_webp:read"}).run(spark)
    assert report["summary"]["unread_by_ending"] == {"jpg": 1}


def test_dedup_links_pictures_of_no_common_band(spark, tmp_path, monkeypatch):
    d = tmp_path / "pool" / "real_a"
    d.mkdir(parents=True)
    hashes = {"a.png": ("0" * 16, "0" * 16), "b.png": ("0001" * 4, "f" * 16), "c.png": ("fff0" * 4, "f" * 15 + "0")}
    for name in hashes:
        (d / name).write_bytes(name.encode())

    def hash_files(paths, root, decode=None):
        facts = [(str(d / n), n, 1, 10, 10, n, "", dh, ph, "00" * 64, "") for n, (ph, dh) in hashes.items()]
        return spark.createDataFrame(facts, "path string, raw_sha1 string, read_ok int, width int, height int, pixel_sha1 string, ahash64 string, dhash64 string, phash64 string, thumb8_hex string, error string")

    monkeypatch.setattr("corpuskit.jobs.hash_files", hash_files)
    manifest = tmp_path / "m.yaml"
    manifest.write_text(yaml.safe_dump({"sources": [{"path": str(d), "label": 0, "name": "real_a"}]}))
    report = build("dedup", {"manifest": str(manifest), "out_dir": f"{tmp_path}/out"}).run(spark)
    assert report["edges"] == {"dedup::near_hash": 2} and report["summary"]["clean_rows"] == 1
