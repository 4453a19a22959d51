"""Manifests, CSV tables, pictures, the embedding cache, scoring and the streamed buffer."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.sources import images as I
from corpuskit.sources import manifest as M
from corpuskit.sources import tables as T
from corpuskit.sources.scoring import score_rows, verdict
from corpuskit.streaming.replay import stream_buffer, stream_error_rates


def picture(seed, h=40, w=50):
    return np.random.default_rng(seed).integers(0, 255, (h, w, 3)).astype(np.uint8)


@pytest.fixture
def tree(tmp_path):
    a, b = tmp_path / "pool" / "real_a", tmp_path / "pool" / "gen_b"
    (a / "shard_0").mkdir(parents=True)
    (b / "deep" / "x").mkdir(parents=True)
    (a / "shard_0" / "One_real.png").write_bytes(I.encode_png(picture(1)))
    (a / "shard_0" / "two_v2.PNG").write_bytes(I.encode_png(picture(1)))
    (a / "shard_0" / "note.txt").write_text("no")
    (b / "top.jpg").write_bytes(b"broken")
    (b / "deep" / "x" / "low.png").write_bytes(I.encode_png(picture(2)))
    (tmp_path / "pool" / "void").mkdir()
    return tmp_path


def spec(tree, **more):
    pool = f"{tree}/pool"
    return {"sources": [{"path": f"{pool}/real_a", "label": 0, "name": "real_a"}, {"path": f"{pool}/gen_b", "label": 1, "split_hint": " UNSEEN ", **more}, {"path": f"{pool}/gen_b/deep", "label": 1, "name": "again"}, {"path": f"{pool}/void", "label": 1}]}


def test_manifest_scan(spark, tree, rows):
    got = {r["filename"]: r for r in M.scan_manifest(spark, spec(tree)).collect()}
    assert set(got) == {"One_real.png", "two_v2.PNG", "top.jpg", "low.png"}
    assert got["One_real.png"]["content_id"] == "one" and got["two_v2.PNG"]["content_id"] == "two" and got["One_real.png"]["group_id"] == "real_a:shard_0"
    assert got["low.png"]["source"] == "gen_b" and got["low.png"]["split_hint"] == "unseen" and got["low.png"]["generator"] == "unknown" and got["low.png"]["relpath"] == "deep/x/low.png"
    assert got["top.jpg"]["file_size_bytes"] == 6 and got["top.jpg"]["mtime"] > 1e9
    flat = M.scan_manifest(spark, {"sources": spec(tree, recursive=False)["sources"][:2]})
    assert "low.png" not in {r["filename"] for r in flat.collect()}
    with pytest.raises(FileNotFoundError, match="void"):
        M.scan_manifest(spark, spec(tree), strict=True)
    with pytest.raises(ValueError):
        M.scan_manifest(spark, {"sources": []})
    with pytest.raises(ValueError):
        M.source_specs({"sources": [{"path": "/x"}]})
    index = M.with_row_index(M.scan_manifest(spark, spec(tree)))
    assert [r["row_idx"] for r in index.orderBy("path").collect()] == [0, 1, 2, 3]


def test_yaml(tmp_path):
    M.save_yaml({"a": [1, "é"]}, f"{tmp_path}/d/x.yaml")
    assert M.load_yaml(f"{tmp_path}/d/x.yaml") == {"a": [1, "é"]}
    (tmp_path / "empty.yaml").write_text("")
    assert M.load_yaml(f"{tmp_path}/empty.yaml") == {}


def test_picture_hashes(spark, tree):
    paths = M.scan_manifest(spark, spec(tree)).select("path", "filename")
    files = I.read_images(spark, f"{tree}/pool").join(paths, "path")
    got = {r["filename"]: r for r in I.hash_images(files).collect()}
    a, b, c = got["One_real.png"], got["two_v2.PNG"], got["low.png"]
    assert a["read_ok"] == 1 and (a["width"], a["height"]) == (50, 40)
    assert a["pixel_sha1"] == hashlib.sha1(b"50x40" + picture(1).tobytes()).hexdigest() == b["pixel_sha1"] != c["pixel_sha1"]
    assert a["raw_sha1"] == hashlib.sha1(I.encode_png(picture(1))).hexdigest()
    assert len(a["thumb8_hex"]) == 128 and all(len(a[k]) == 16 for k in ("ahash64", "dhash64", "phash64")) and int(a["phash64"], 16) < 1 << 63
    bad = got["top.jpg"]
    assert bad["read_ok"] == 0 and bad["width"] == -1 and bad["phash64"] == "" and "PNG" in bad["error"]


def test_jvm_decoded_pixels(spark, tree):
    got = {r["path"].rsplit("/", 1)[1]: r for r in I.hash_images(I.read_pixels(spark, f"{tree}/pool/real_a"), decode=I.decode_raw).collect()}
    assert got["One_real.png"]["pixel_sha1"] == I.picture_hashes(picture(1))["pixel_sha1"]
    assert got["One_real.png"]["phash64"] == I.picture_hashes(picture(1))["phash64"]


def test_hash_definitions():
    flat = np.full((20, 20, 3), 77, np.uint8)
    h = I.picture_hashes(flat)
    assert h["ahash64"] == h["dhash64"] == "0" * 16 and set(bytes.fromhex(h["thumb8_hex"])) == {77}
    ramp = np.repeat(np.arange(0, 180, 2, dtype=np.uint8)[None, :, None], 60, axis=0).repeat(3, axis=2)
    assert I.picture_hashes(ramp)["dhash64"] == "f" * 16 and I.picture_hashes(ramp)["ahash64"] == "0f" * 8
    small, large = picture(3, 64, 64).astype(float), None
    smooth = I.resize(small[:, :, 0], 16, 16)
    large = np.clip(I.resize(smooth, 256, 256), 0, 255).astype(np.uint8)[:, :, None].repeat(3, axis=2)
    half = np.clip(I.resize(smooth, 128, 128), 0, 255).astype(np.uint8)[:, :, None].repeat(3, axis=2)
    bits = lambda k: (int(I.picture_hashes(large)[k], 16) ^ int(I.picture_hashes(half)[k], 16)).bit_count()
    assert bits("phash64") <= 6 and bits("dhash64") <= 6


def filtered_png(rgb, mode):
    """The picture with one of PNG's line filters applied."""
    import struct
    import zlib

    h, w, _ = rgb.shape
    flat = rgb.reshape(h, w * 3).astype(int)
    lines = []
    for y in range(h):
        up = flat[y - 1] if y else np.zeros(w * 3, int)
        left = np.r_[0, 0, 0, flat[y][:-3]]
        corner = np.r_[0, 0, 0, up[:-3]]
        p = left + up - corner
        near = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        guess = [0, left, up, (left + up) // 2, near][mode]
        lines.append(bytes([mode]) + ((flat[y] - guess) & 255).astype(np.uint8).tobytes())
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("mode", range(5))
def test_png_filters(mode):
    rgb = picture(mode, 9, 7)
    assert (I.decode_png(filtered_png(rgb, mode)) == rgb).all()


def test_csv_tables(spark, tmp_path, rows):
    df = spark.createDataFrame([("/a", 1, ' say "hi", ok\nline ', "x"), ("/b", None, "", None)], "path string, label int, source string, extra string").select("extra", "source", "label", "path")
    T.write_samples(df, f"{tmp_path}/c")
    back = T.read_samples(spark, f"{tmp_path}/c")
    assert back.columns == ["path", "label", "source", "extra"] and rows(back) == rows(T.ordered_columns(df))
    (tmp_path / "bad.csv").write_text("path,source\n/a,x\n")
    with pytest.raises(ValueError, match="label"):
        T.read_samples(spark, f"{tmp_path}/bad.csv")
    (tmp_path / "odd.csv").write_text("path,label,sample_weight\n/a,zero,heavy\n")
    assert rows(T.read_samples(spark, f"{tmp_path}/odd.csv")) == [("/a", None, None)]


def test_embedding_cache(spark, tmp_path, rows):
    done = []

    def embed(df):
        done.append(sorted(r[0] for r in df.select("sha").collect()))
        return df.select("sha", F.array(F.length("sha").cast("float")).alias("vector"))

    cache = T.EmbeddingCache(spark, f"{tmp_path}/cache")
    df = spark.createDataFrame([("a",), ("bb",), ("bb",), (None,)], "sha string")
    assert cache.fill(df, "sha", "m1", embed).count() == 2
    more = spark.createDataFrame([("bb",), ("ccc",)], "sha string")
    assert rows(cache.fill(more, "sha", "m1", embed), "sha") == [("bb",), ("ccc",)]
    cache.fill(more, "sha", "m2", embed)
    assert done == [["a", "bb"], ["ccc"], ["bb", "ccc"]]


def test_scoring(spark, rows):
    df = spark.createDataFrame([("/a", 1.0), ("/b", 3.0), (None, 9.0)], "path string, x double")
    views = score_rows(df, lambda: lambda pdf: np.stack([pdf.x, pdf.x * 3], axis=1), views=2)
    assert rows(views) == [("/a", 2.0), ("/b", 6.0)]
    text = views.select(verdict("path", "score", 3.0)).collect()[0][0]
    assert '"threshold":3.0' in text
    with pytest.raises(ValueError):
        score_rows(df, lambda: None, views=6)


def test_streamed_buffer(spark, tmp_path, rows):
    schema = "path string, label int, source string, priority double, sample_weight double, score double, mined_at string, is_error int"
    first = [(f"/p{i}", 0, "a", float(i), 1.0, 0.5, "2025-01-01T00:00:00", 1) for i in range(6)]
    second = [("/p0", 0, "a", 50.0, 1.0, 0.5, "2025-01-02T00:00:00", 0), ("/q", 0, "b", 0.5, 1.0, 0.5, "2025-01-02T00:00:00", 1)]
    typed = spark.createDataFrame(first, schema)
    for batch in (first, second):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = stream_buffer(spark, f"{tmp_path}/in", typed.schema, f"{tmp_path}/buffer", f"{tmp_path}/cp", 4)
        q.awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmp_path}/buffer"), "path") == [("/p0",), ("/p4",), ("/p5",), ("/q",)]
    rates = stream_error_rates(spark, f"{tmp_path}/in", typed.schema)
    q = rates.writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("rates"), "source", "rows", "errors") == [("a", 1, 0), ("a", 6, 6), ("b", 1, 1)]


def laced_png(rgb16):
    """A 16-bit RGB PNG in Adam7 passes."""
    import struct
    import zlib

    h, w, _ = rgb16.shape
    body = b""
    for y, x, down, across in ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)):
        for line in rgb16[y::down, x::across]:
            body += b"\0" + line.astype(">u2").tobytes() if line.size else b""
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 16, 2, 0, 0, 1)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def gray_png(values, depth):
    """A gray PNG of less than 8 bits a sample."""
    import struct
    import zlib

    h, w = values.shape
    bits = (values[:, :, None] >> np.arange(depth - 1, -1, -1) & 1).reshape(h, w * depth)
    body = b"".join(b"\0" + line.tobytes() for line in np.packbits(bits.astype(np.uint8), axis=1))
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("size", [(1, 1), (3, 5), (13, 9)])
def test_png_depths(size):
    rgb = np.random.default_rng(5).integers(0, 1 << 16, (*size, 3))
    assert (I.decode_png(laced_png(rgb)) == rgb >> 8).all()
    for depth in (1, 2, 4):
        v = np.random.default_rng(depth).integers(0, 1 << depth, size)
        assert (I.decode_png(gray_png(v, depth)) == (v * 255 // ((1 << depth) - 1))[:, :, None]).all()


def jvm_picture(spark, png, path, kind):
    io, file = spark._jvm.javax.imageio.ImageIO, spark._jvm.java.io.File
    assert io.write(io.read(file(str(png))), kind, file(str(path)))
