"""Media columns: texts stored as lossless WebP images, and features of the pixels read back.

A payload (the text's UTF-8 bytes, then bytes 255 up to a positive multiple of 576) becomes images 144
pixels across and TILE_ROWS rows high at most, R, G, B, A samples row by row; the stored form is their
files one after another. Each image is written in the way that its samples make smallest: see plans_of(). The
stored forms are written to the shared folder and read back from there. Null and empty texts are one row of 255. Repeated
rows and equal texts have equal values. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm import webp, webp_many
from leafmill.llm.shared import materialize, whole_text

#: Rows of an image at most: short images keep the joint decoding even.
TILE_ROWS = 16
#: For callers of plans_of() that prefer the fixed text code, which is coded and decoded for many images at once: another way has to be estimated at less than this
#: share of its bits. Stored forms take the least estimate whatever it saves (LEAST).
SAVING, LEAST = 0.5, 1.0
#: Estimated bits of an image's own prefix codes, and of a reference to 32 earlier pixels.
CODES, REFERENCE = 2500, 24
#: Payload bytes that are encoded or decoded together.
AT_ONCE = 2 << 20


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\xff" * (-len(data) % webp.ROW if data else webp.ROW)


def _entropy(samples: np.ndarray) -> np.ndarray:
    """Bits of each image's samples (images, pixels, 4) under prefix codes of its own for each channel."""
    n, pixels, _ = samples.shape
    at = (np.arange(n)[:, None, None] * 4 + np.arange(4)) * 256 + samples
    counts = np.bincount(at.ravel(), minlength=n * 1024).reshape(n, 4, 256)
    bits = np.arange(pixels + 1) * np.log2(np.maximum(np.arange(pixels + 1), 1))
    return (pixels * np.log2(pixels) * 4) - bits[counts].sum(axis=(1, 2))


def _element(samples: np.ndarray) -> int:
    """The cross-colour element of an image: the slopes of red and blue over green, and of what is left of blue over red."""
    red, green, blue = (samples[:, c].astype(np.int8).astype(float) for c in range(3))
    slope = lambda y, x: int(np.clip(np.round(32 * (x @ y) / max(x @ x, 1)), -128, 127)) & 255
    return slope(red, green) | slope(blue, green) << 8


def plans_of(tiles: np.ndarray, saving: float = SAVING) -> list[dict | None]:
    """How webp.encode() writes each image (images, pixels, 4) of one size, or None for the text code.

    The bits of the text code are known. Those of the others are estimated: samples under own codes as they are, less green, less
    the pixel to the left or above, or less what green gives red and blue; palettes of up to 256 colours; references and a
    colour cache where most runs of eight pixels were there before. The least counts, the first of equals, if it is under the share `saving`
    of the text code's bits.
    """
    n, pixels, _ = tiles.shape
    rows = tiles.reshape(n, -1, webp.PIXELS, 4)
    text = webp.HEADER_BITS + webp.SIZE[tiles.reshape(n, -1)].sum(axis=1)
    green = tiles.copy()
    green[..., [0, 2]] -= tiles[..., 1:2]
    left, above = rows.copy(), rows.copy()
    left[:, :, 1:] -= rows[:, :, :-1]
    left[:, 1:, 0] -= rows[:, :-1, 0]
    above[:, 1:] -= rows[:, :-1]
    above[:, 0, 1:] -= rows[:, 0, :-1]
    ways: list[tuple[dict, np.ndarray]] = [({}, _entropy(tiles)), ({"transforms": (webp.SUBTRACT_GREEN,)}, _entropy(green)), ({"transforms": (webp.PREDICTOR,), "mode": 1}, _entropy(left.reshape(tiles.shape))), ({"transforms": (webp.PREDICTOR,), "mode": 2}, _entropy(above.reshape(tiles.shape)))]
    elements = [_element(t) for t in tiles]
    crossed = tiles.copy()
    for c, shift in ((0, 0), (2, 8)):
        factor = np.array([(e >> shift) & 255 for e in elements], np.uint8).astype(np.int8).astype(np.int32)
        crossed[..., c] -= (factor[:, None] * tiles[..., 1].astype(np.int8) >> 5).astype(np.uint8)
    ways.append(({"transforms": (webp.CROSS_COLOUR,)}, _entropy(crossed)))
    colours = np.ascontiguousarray(tiles).view("<u4")[..., 0]
    ordered = np.sort(colours, axis=1)
    different = 1 + (ordered[:, 1:] != ordered[:, :-1]).sum(axis=1)
    new = np.append(np.ones((n, 1), bool), ordered[:, 1:] != ordered[:, :-1], axis=1)
    starts = np.flatnonzero(new.ravel())
    runs = np.diff(np.append(starts, n * pixels)).astype(float)
    own = pixels * np.log2(pixels) - np.bincount(starts // pixels, runs * np.log2(runs), n)
    ways.append(({"transforms": (webp.PALETTE,), "references": True}, np.where(different <= 256, 32 * different + own, np.inf)))
    run = colours.astype(np.uint64)
    for k in (1, 2, 4):  # a hash of each run of eight pixels
        run = run[:, :-k] * np.uint64(0x9E3779B97F4A7C15) ^ run[:, k:] * np.uint64(0xD6E8FEB86659FD93) ^ run[:, :-k] >> np.uint64(29)
    run = np.sort(run, axis=1)
    again = 1 - (1 + (run[:, 1:] != run[:, :-1]).sum(axis=1)) / run.shape[1]
    ways.append(({"references": True, "cache_bits": 8}, (1 - again) * ways[0][1] + REFERENCE * again * pixels / 32))
    bits = np.stack([b for _, b in ways], axis=1) + CODES
    best = bits.argmin(axis=1)
    return [ways[k][0] | ({"element": e} if webp.CROSS_COLOUR in ways[k][0].get("transforms", ()) else {}) if bits[i, k] < saving * text[i] else None for i, (k, e) in enumerate(zip(best.tolist(), elements, strict=True))]


def store(payloads: list[bytes]) -> list[bytes]:
    """The stored form of each payload."""
    step = TILE_ROWS * webp.ROW
    tiles = [(i, p[a : a + step]) for i, p in enumerate(payloads) for a in range(0, len(p), step)]
    files: list[bytes] = [b""] * len(tiles)
    of_size: dict[int, list[int]] = {}
    for k, (_, t) in enumerate(tiles):
        of_size.setdefault(len(t), []).append(k)
    plain, coded = [], []
    for size, own in of_size.items():
        samples = np.frombuffer(b"".join([tiles[k][1] for k in own]), np.uint8).reshape(len(own), size // 4, 4)
        for k, image, plan in zip(own, samples, plans_of(samples, LEAST), strict=True):
            if plan is None:
                plain.append(k)
            elif plan.keys() <= {"references", "cache_bits"} and plan.get("cache_bits", webp_many.CACHE_BITS) == webp_many.CACHE_BITS:
                coded.append((k, image.reshape(-1, webp.PIXELS, 4), plan))
            else:
                files[k] = webp.encode(image.reshape(-1, webp.PIXELS, 4), **plan)
    for k, f in zip(plain, webp.encode_texts([tiles[k][1] for k in plain]), strict=True):
        files[k] = f
    references, cache = (np.array([name in plan for _, _, plan in coded], bool) for name in ("references", "cache_bits"))
    for (k, _, _), f in zip(coded, webp_many.encode_many([image for _, image, _ in coded], references, cache), strict=True):
        files[k] = f
    out: list[list[bytes]] = [[] for _ in payloads]
    for (i, _), f in zip(tiles, files, strict=True):
        out[i].append(f)
    return [b"".join(x) for x in out]


def load(media: list[bytes]) -> list[bytes]:
    """The payloads of stored forms."""
    files, owners = [], []
    for i, m in enumerate(media):
        at = 0
        while at < len(m):
            size = 8 + struct.unpack_from("<I", m, at + 4)[0]
            files.append(m[at : at + size])
            owners.append(i)
            at += size
    out: list[list[bytes]] = [[] for _ in media]
    for i, p in zip(owners, webp_many.decode_many(files), strict=True):
        out[i].append(p)
    return [b"".join(x) for x in out]


def feature_of(payload: bytes) -> str:
    """Mean sample of each of 16 runs of the payload, as hexadecimal digits."""
    samples = np.frombuffer(payload, np.uint8)
    edges = [len(samples) * i // 16 for i in range(16)]
    sums = np.add.reduceat(samples, edges, dtype=np.int64)
    return bytes((sums // np.diff([*edges, len(samples)])).astype(np.uint8)).hex()


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= AT_ONCE:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def write_media(docs: DataFrame) -> DataFrame:
    """media_column(), written to the shared folder and read from there."""
    return materialize(media_column(docs), "media")


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (binary) of every row."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for a, b in _runs([len(t) for t in texts]):
                payload = {t: payload_of(t) for t in texts[a:b]}
                media = dict(zip(payload, store(list(payload.values())), strict=True))
                sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array(sizes, pa.int64()), pa.array([media[t] for t in texts[a:b]], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, n_bytes bigint, media binary")


def features(stored: DataFrame) -> DataFrame:
    """What the pixels read back from `media` give: sizes, hashes and a feature of every row."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, sizes, media = (c.to_pylist() for c in batch.columns)
            for a, b in _runs([len(m) for m in media]):
                made = {}
                own = list(dict.fromkeys(media[a:b]))
                for m, p in zip(own, load(own), strict=True):
                    made[m] = (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(p))
                columns = zip(*[made[m] for m in media[a:b]], strict=True)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array(sizes[a:b], pa.int64()), *arrays], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
