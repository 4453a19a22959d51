"""Picture bytes to content and perceptual hashes, in Arrow batches with NumPy alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HASHES = "read_ok int, width int, height int, pixel_sha1 string, ahash64 string, dhash64 string, phash64 string, thumb8_hex string, error string"


def _png_lines(raw, at: int, height: int, width: int, channels: int, depth: int):
    """(samples [height, width, channels] as 8 bits or palette places, end) of one pass of filtered lines."""
    import numpy as np

    size, step = (width * channels * depth + 7) // 8, max(1, channels * depth // 8)
    end = at + height * (1 + size)
    lines = raw[at:end].reshape(height, 1 + size)
    out = np.zeros((height, size), np.uint8)
    above = np.zeros(size, np.int64)
    for y in range(height):
        mode, line = lines[y, 0], lines[y, 1:].astype(np.int64)
        if mode == 2:
            line = line + above
        elif mode == 1:
            padded = np.concatenate([line, np.zeros(-size % step, np.int64)])
            line = np.add.accumulate(padded.reshape(-1, step), axis=0).reshape(-1)[:size]
        elif mode in (3, 4):
            for x in range(len(line)):
                left = line[x - step] if x >= step else 0
                up, corner = above[x], above[x - step] if x >= step else 0
                if mode == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    guess = min((left, up, corner), key=lambda v: abs(p - v))
                line[x] = (line[x] + guess) & 255
        above = line & 255
        out[y] = above
    if depth == 16:
        out = out[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(out, axis=1).reshape(height, -1, depth)
        out = (bits @ (1 << np.arange(depth - 1, -1, -1))).astype(np.uint8)[:, : width * channels]
    return out.reshape(height, width, channels), end


def decode_png(data: bytes):
    """RGB array [height, width, 3] of a PNG of any depth, interlaced or not; of 16 bits the upper
    eight are kept, transparency is not applied."""
    import struct
    import zlib

    import numpy as np

    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, palette = 8, [], None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, depth, color, _, _, lace = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    passes = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)) if lace else ((0, 0, 1, 1),)
    px, at = np.zeros((height, width, channels), np.uint8), 0
    for y, x, down, across in passes:
        h, w = len(range(y, height, down)), len(range(x, width, across))
        if h and w:
            px[y::down, x::across], at = _png_lines(raw, at, h, w, channels, depth)
    if at != len(raw):
        raise ValueError("PNG of another size")
    if color == 3:
        return palette[px[:, :, 0]]
    if depth < 8:
        px = (px.astype(np.int64) * 255 // ((1 << depth) - 1)).astype(np.uint8)
    return np.repeat(px[:, :, :1], 3, axis=2) if channels < 3 else px[:, :, :3].copy()


def decode_raw(data: bytes):
    """RGB array of the form that read_pixels gives: height,width,channels; and BGR bytes."""
    import numpy as np

    head, _, body = data.partition(b";")
    h, w, c = map(int, head.split(b","))
    px = np.frombuffer(body, np.uint8).reshape(h, w, c)
    return np.repeat(px, 3, axis=2) if c == 1 else px[:, :, 2::-1].copy()


def gray(rgb):
    """Luma as float."""
    import numpy as np

    return rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def resize(img, height: int, width: int, cache: dict | None = None):
    """Area-weighted triangle (antialiased bilinear) resampling of a 2-D array."""
    import numpy as np

    cache = {} if cache is None else cache

    def matrix(n: int, m: int):
        if (n, m) not in cache:
            scale = max(1.0, n / m)
            centers = (np.arange(m) + 0.5) * n / m - 0.5
            w = np.clip(1 - np.abs(np.arange(n)[None, :] - centers[:, None]) / scale, 0, None)
            cache[n, m] = w / w.sum(axis=1, keepdims=True)
        return cache[n, m]

    return matrix(img.shape[0], height) @ img @ matrix(img.shape[1], width).T


def bits_hex(bits) -> str:
    """64 bits, first bit highest, as 16 hexadecimal digits."""
    import numpy as np

    return np.packbits(np.asarray(bits, dtype=bool).reshape(-1)).tobytes().hex()


def picture_hashes(rgb, cache: dict | None = None) -> dict:
    """Sizes, pixel hash, average, difference and frequency hash, and 8 x 8 thumbnail of a picture.

    cache keeps resampling matrices from one picture to the next.
    """
    import hashlib

    import numpy as np

    h, w = rgb.shape[:2]
    g = gray(rgb)
    cache = {} if cache is None else cache
    # halves are told apart from what sums leave of them
    small, wide, big = (np.round(np.round(resize(g, a, b, cache), 6)) for a, b in ((8, 8), (8, 9), (32, 32)))
    if "dct" not in cache:
        k = np.arange(32)
        cache["dct"] = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))[:, None]
    basis = cache["dct"]
    low = (basis @ big @ basis.T)[:8, :8].reshape(-1)
    low = np.round(low, 6)
    frequency = low > np.median(low[1:])
    frequency[0] = False
    return {
        "read_ok": 1,
        "width": w,
        "height": h,
        "pixel_sha1": hashlib.sha1(f"{w}x{h}".encode() + np.ascontiguousarray(rgb, dtype=np.uint8).tobytes()).hexdigest(),
        "ahash64": bits_hex(small > small.mean()),
        "dhash64": bits_hex(wide[:, 1:] > wide[:, :-1]),
        "phash64": bits_hex(frequency),
        "thumb8_hex": np.clip(small, 0, 255).astype(np.uint8).tobytes().hex(),
        "error": "",
    }


def hash_images(df: DataFrame, content: str = "content", decode: Callable = decode_png) -> DataFrame:
    """df without ``content``, with raw_sha1 and the HASHES columns.

    Bytes that ``decode`` can't read give read_ok 0, sizes -1, blank hashes and the error.
    """
    kept = [c for c in df.columns if c != content]
    fields = [f.split()[0] for f in HASHES.split(", ")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != content)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        cache: dict = {}
        for pdf in batches:
            if len(cache) > 1000:
                cache.clear()
            rows = []
            for data in pdf["__bytes"]:
                try:
                    rows.append(picture_hashes(decode(bytes(data)), cache))
                except Exception as e:  # noqa: BLE001 - a file that can't be read is a row, not a failure
                    rows.append(dict.fromkeys(fields, "") | {"read_ok": 0, "width": -1, "height": -1, "error": f"{type(e).__name__}: {e}"[:200]})
            out = pdf.drop(columns="__bytes").reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame(rows, columns=fields)], axis=1)

    whole = df.select(*kept, F.col(content).alias("__bytes"), F.sha1(content).alias("raw_sha1"))
    return whole.mapInPandas(run, f"{schema + ', ' if schema else ''}raw_sha1 string, {HASHES}")


def read_images(spark: SparkSession, root: str, endings: Sequence[str] | None = None, recursive: bool = True) -> DataFrame:
    """path, content of all files under root, or of those with the endings, in lower case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    if endings is not None:
        files = files.filter(F.lower(F.substring_index("_metadata.file_name", ".", -1)).isin(list(endings)))
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")


def read_pixels(spark: SparkSession, root: str, endings: Sequence[str] | None = None) -> DataFrame:
    """path, content of all pictures the JVM can decode (JPEG, PNG, BMP, GIF), for decode_raw; others
    have null content or no row. endings: only files with these, in lower case. No rotation is applied."""
    pics = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").option("ignoreCorruptFiles", "true").load(root)
    if endings is not None:
        pics = pics.filter(F.lower(F.substring_index("_metadata.file_name", ".", -1)).isin(list(endings)))
    pics = pics.select("image.*")
    head = F.encode(F.format_string("%d,%d,%d;", "height", "width", "nChannels"), "utf-8")
    content = F.when(F.col("width") > 0, F.concat(head, F.col("data")))
    plain = F.url_decode(F.replace("origin", F.lit("+"), F.lit("%2B")))
    return pics.select(F.regexp_replace(plain, "^file:/*", "/").alias("path"), content.alias("content"))


def named_decoder(name: str) -> Callable:
    """The function bytes -> RGB array that ``module:function`` names, imported where it runs."""

    def decode(data: bytes):
        import importlib

        module, function = name.split(":")
        return getattr(importlib.import_module(module), function)(data)

    return decode


def hash_files(paths: DataFrame, root: str, decode: Callable | None = None, batch: int = 256) -> DataFrame:
    """path, raw_sha1 and the HASHES columns of the files under root that paths names.

    Files go to one decoder after the other until one reads them: decode_png, the JVM's (JPEG, BMP,
    GIF), ``decode``. raw_sha1 is always that of the file. Files that none reads keep read_ok 0. A Python
    worker is handed ``batch`` files at a time.
    """
    conf, name = paths.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(batch))
    try:
        return _hash_files(paths, root, decode)
    finally:
        conf.set(name, before)


def _hash_files(paths: DataFrame, root: str, decode: Callable | None) -> DataFrame:
    from ..operators.common import lookup_join, materialize

    spark, fields = paths.sparkSession, [f.split()[0] for f in HASHES.split(", ")]
    wanted = paths.select("path").distinct()
    ends = lambda df: [r[0] for r in df.select(F.lower(F.substring_index("path", ".", -1))).distinct().collect()]
    # contents are hashed where they are read, and only then joined: no picture is moved
    out = materialize(lookup_join(hash_images(read_images(spark, root, ends(wanted))), wanted, ["path"], "left_semi"))
    for again in ("jvm", "own"):
        left = out.filter("read_ok = 0").select("path")
        if again == "own" and decode is None or left.isEmpty():
            continue
        if again == "jvm":
            found = hash_images(read_pixels(spark, root, ends(left)).filter("content IS NOT NULL"), decode=decode_raw)
        else:
            found = hash_images(read_images(spark, root, ends(left)), decode=decode)
        found = materialize(found.filter("read_ok = 1").select("path", F.struct(*fields).alias("__found")))
        merged = [F.when(F.col("__found").isNotNull() & (F.col("read_ok") == 0), F.col(f"__found.{c}")).otherwise(F.col(c)).alias(c) for c in fields]
        out = materialize(out.join(found, "path", "left").select("path", "raw_sha1", *merged))
    return out


def encode_png(rgb) -> bytes:
    """An 8-bit RGB PNG of an array."""
    import struct
    import zlib

    import numpy as np

    h, w = rgb.shape[:2]
    lines = np.concatenate([np.zeros((h, 1), np.uint8), np.asarray(rgb, np.uint8).reshape(h, w * 3)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")
