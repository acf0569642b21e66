"""Contracts of image kernels and models, with numpy versions where numpy does.

Images are encoded arrays: a struct<height int, width int, channels int, data
binary> of uint8 in row order.  Decoders and models are passed in as
functions; they are loaded once per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import pandas_udf, udtf

IMAGE = "struct<height:int,width:int,channels:int,data:binary>"

# Least short side and gradient of readable text; names of the preprocessings and rotations in order.
MIN_SIDE = 60
MIN_GRADIENT = 80.0
PREPROCESSINGS = ["gray", "equalize_hist", "adaptive_thresh", "adaptive_thresh_inv", "gaussian_blur", "upscale2x", "sharpen"]
ROTATIONS = ["rot0", "rot90cw", "rot180", "rot90ccw"]


def variant_names() -> list[str]:
    return [f"{p}_{r}" for p in PREPROCESSINGS for r in ROTATIONS]


def to_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return a.reshape(height, width) if channels == 1 else a.reshape(height, width, channels)


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of blue, green, red."""
    if image.ndim == 2:
        return image
    return np.clip(np.rint(image @ np.array([0.114, 0.587, 0.299])), 0, 255).astype(np.uint8)


def correlate3(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Three by three correlation with the border mirrored about the outermost pixel."""
    p = np.pad(image.astype(np.float64), 1, mode="reflect" if min(image.shape) > 1 else "edge")
    h, w = image.shape
    return sum(kernel[i, j] * p[i : i + h, j : j + w] for i in range(3) for j in range(3))


_SOBEL = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], float)
_LAPLACE = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], float)


def text_pixels(image: np.ndarray | None) -> float:
    """Pixels with a gradient over MIN_GRADIENT; 0 for images with a short side under MIN_SIDE."""
    if image is None or image.size == 0 or min(image.shape[:2]) < MIN_SIDE:
        return 0.0
    g = gray(image)
    return float((np.hypot(correlate3(g, _SOBEL), correlate3(g, _SOBEL.T)) > MIN_GRADIENT).sum())


def laplacian_variance(image: np.ndarray | None) -> float:
    return 0.0 if image is None or image.size == 0 else float(correlate3(gray(image), _LAPLACE).var())


def image_score(image: Column, score: Callable[[np.ndarray], float]) -> Column:
    """A kernel over an image column as doubles; null images score null."""

    @pandas_udf("double")
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series([None if pd.isna(h) else score(to_array(int(h), int(w), int(c), d)) for h, w, c, d in zip(p["height"], p["width"], p["channels"], p["data"])], dtype="float64")

    return run(image)


def crop_rotated(image: np.ndarray, box: tuple[int, int, int, int], degrees: int = 0) -> np.ndarray | None:
    """The part of an image within a box, clamped to it, turned clockwise; None if nothing is left."""
    h, w = image.shape[:2]
    x1, y1, x2, y2 = max(0, box[0]), max(0, box[1]), min(w, box[2]), min(h, box[3])
    if x2 <= x1 or y2 <= y1:
        return None
    return np.rot90(image[y1:y2, x1:x2], -(degrees // 90))


def to_bytes(image: np.ndarray) -> np.ndarray:
    """Rounded half to even and held to 0..255."""
    return np.clip(np.rint(image), 0, 255).astype(np.uint8)


def equalized(image: np.ndarray) -> np.ndarray:
    """Grey values spread by their cumulative counts; an image of one value stays."""
    counts = np.bincount(image.ravel(), minlength=256)
    first = int(np.flatnonzero(counts)[0])
    rest = image.size - counts[first]
    if not rest:
        return image.copy()
    table = np.cumsum(np.where(np.arange(256) > first, counts, 0)) * (255.0 / rest)
    return to_bytes(table)[image]


def gaussian(image: np.ndarray, size: int, sigma: float, mode: str) -> np.ndarray:
    """Separable Gaussian mean over an odd size, as doubles; ``mode`` is the border of numpy.pad."""
    x = np.arange(size) - size // 2
    k = np.exp(-(x**2) / (2 * sigma**2))
    k /= k.sum()
    half = size // 2
    if min(image.shape) <= half and mode == "reflect":
        mode = "edge"
    p = np.pad(image.astype(np.float64), half, mode=mode)
    p = sum(k[i] * p[i : i + image.shape[0]] for i in range(size))
    return sum(k[i] * p[:, i : i + image.shape[1]] for i in range(size))


def binarized(image: np.ndarray, size: int = 31, less: int = 5) -> np.ndarray:
    """White where a pixel is above the Gaussian mean round it less a constant."""
    mean = to_bytes(gaussian(image, size, 0.3 * ((size - 1) * 0.5 - 1) + 0.8, "edge"))
    return np.where(image.astype(np.int16) - mean > -less, 255, 0).astype(np.uint8)


def blurred3(image: np.ndarray) -> np.ndarray:
    """Binomial mean of three by three."""
    return to_bytes(correlate3(image, np.outer([1, 2, 1], [1, 2, 1]) / 16))


def sharpened(image: np.ndarray) -> np.ndarray:
    return to_bytes(correlate3(image, np.array([[0, -1, 0], [-1, 5, -1], [0, -1, 0]], float)))


def resized_cubic(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Cubic interpolation (a = -0.75) about pixel centres; the outermost pixels go on beyond the border."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        at = (np.arange(n) + 0.5) * (len(x) / n) - 0.5
        low = np.floor(at).astype(int)
        out = 0.0
        for k in range(-1, 3):
            d = np.abs(at - (low + k))
            w = np.where(d <= 1, 1.25 * d**3 - 2.25 * d**2 + 1, -0.75 * (d**3 - 5 * d**2 + 8 * d - 4))
            out = out + w.reshape(-1, *[1] * (x.ndim - 1)) * x[np.clip(low + k, 0, len(x) - 1)]
        return out

    return to_bytes(np.swapaxes(along(np.swapaxes(along(image.astype(np.float64), height), 0, 1), width), 0, 1))


def preprocessings() -> dict[str, Callable[[np.ndarray], np.ndarray]]:
    """The seven preprocessings by name; each takes a colour or grey image."""
    steps = {
        "gray": lambda g: g,
        "equalize_hist": equalized,
        "adaptive_thresh": binarized,
        "adaptive_thresh_inv": lambda g: 255 - binarized(g),
        "gaussian_blur": blurred3,
        "upscale2x": lambda g: resized_cubic(g, 2 * g.shape[0], 2 * g.shape[1]),
        "sharpen": sharpened,
    }
    return {name: (lambda image, f=f: f(gray(image))) for name, f in steps.items()}


def variants(image: np.ndarray, steps: dict[str, Callable[[np.ndarray], np.ndarray]] | None = None) -> Iterator[tuple[int, str, np.ndarray]]:
    """(index, name, image) of each preprocessing in each rotation, in order; with ``steps`` only of those."""
    steps = preprocessings() if steps is None else steps
    i = 0
    for name in PREPROCESSINGS:
        made = steps[name](image) if name in steps else None
        for k, turn in enumerate(ROTATIONS):
            if made is not None:
                yield i, f"{name}_{turn}", np.rot90(made, -k)
            i += 1


@udtf(returnType="variant_idx int, variant_name string, height int, width int, data binary")
class ImageVariants:
    """Table function over (height, width, channels, data): all 28 variants in order."""

    def eval(self, height: int, width: int, channels: int, data: bytes) -> Iterator[tuple]:
        if data is not None:
            for i, name, v in variants(to_array(height, width, channels, data)):
                yield i, name, v.shape[0], v.shape[1], np.ascontiguousarray(v).tobytes()


#: A reader of square codes: an image to (format, text) of what it finds. The format that is preferred, the short side that images are enlarged to.
Reader = Callable[[np.ndarray], list[tuple[str, str]]]
SQUARE, SHORT_SIDE = "QRCode", 1500


def square_variants(image: np.ndarray) -> Iterator[np.ndarray]:
    """The image enlarged (if its short side is under SHORT_SIDE), unsharp-masked, and binarised."""
    h, w = image.shape[:2]
    if min(h, w) < SHORT_SIDE:
        scale = SHORT_SIDE / min(h, w)
        yield resized_cubic(image, round(h * scale), round(w * scale))
    g = gray(image)
    yield to_bytes(1.6 * g - 0.6 * to_bytes(gaussian(g, 13, 2.0, "reflect")))
    yield binarized(g, 31, 10)


def read_square(image: np.ndarray | None, readers: list[tuple[str, Reader]]) -> tuple[str, str]:
    """(payload, source) of the first reader that finds text: each on the image, then each on every variant.

    A code of the square format goes before any other. The source is the
    reader's name, with ``+preprocN`` for the N-th variant; both are blank if
    nothing is found. A reader that fails has found nothing.
    """
    if image is None or image.size == 0:
        return "", ""

    def ask(read: Reader, x: np.ndarray) -> str:
        try:
            found = [(kind, text) for kind, text in read(x) if text]
        except Exception:  # a plug-in's own errors
            return ""
        return next((text for kind, text in found if kind == SQUARE), found[0][1] if found else "")

    for n, x in enumerate(chain([image], square_variants(image))):
        for name, read in readers:
            if text := ask(read, x):
                return text, f"{name}+preproc{n}" if n else name
    return "", ""


def read_squares(images: DataFrame, load: Callable[[], list[tuple[str, Reader]]], keys: list[str], image: str = "image") -> DataFrame:
    """(keys, payload, source) of an image column. ``load`` runs once per task and gives the readers in order."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = load()
        for p in parts:
            found = [read_square(None if x is None else to_array(x["height"], x["width"], x["channels"], x["data"]), readers) for x in p[image]]
            yield p[keys].assign(payload=[t for t, _ in found], source=[s for _, s in found])

    types = dict(images.dtypes)
    return images.select(*keys, image).mapInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", payload string, source string")


def png(image: np.ndarray) -> bytes:
    """A grey, or blue-green-red, image as a PNG file."""
    import struct
    import zlib

    h, w = image.shape[:2]
    rows = np.ascontiguousarray(image if image.ndim == 2 else image[:, :, ::-1]).reshape(h, -1)
    body = np.hstack([np.zeros((h, 1), np.uint8), rows]).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def motion_blur(image: np.ndarray, length: int, degrees: float) -> np.ndarray:
    """Mean along a line of odd length."""
    half = length // 2
    t = np.linspace(-half, half, length)
    dx, dy = np.rint(t * np.cos(np.radians(degrees))).astype(int), np.rint(t * np.sin(np.radians(degrees))).astype(int)
    p = np.pad(image.astype(np.float64), [(half, half), (half, half)] + [(0, 0)] * (image.ndim - 2), mode="edge")
    h, w = image.shape[:2]
    return np.clip(np.rint(sum(p[half + b : half + b + h, half + a : half + a + w] for a, b in zip(dx, dy)) / length), 0, 255).astype(np.uint8)


def glare(image: np.ndarray, spots: list[tuple[float, float, float]], strength: float = 0.8) -> np.ndarray:
    """Bright spots (centre and radius as shares of the size) laid over an image."""
    h, w = image.shape[:2]
    y, x = np.mgrid[0:h, 0:w]
    light = np.zeros((h, w))
    for cx, cy, r in spots:
        light = np.maximum(light, np.exp(-(((x - cx * w) ** 2 + (y - cy * h) ** 2) / (2 * (r * max(h, w)) ** 2))))
    light = (strength * light)[..., None] if image.ndim == 3 else strength * light
    return np.clip(np.rint(image + (255 - image.astype(np.float64)) * light), 0, 255).astype(np.uint8)


def copy_parameters(key: str, copy: int, seed: int = 42) -> np.random.Generator:
    """Random numbers of one augmented copy, whatever the order of the rows."""
    import zlib

    return np.random.default_rng([seed, zlib.crc32(key.encode()), copy])


# Odd lengths and angles of motion blur, numbers of glare spots.
BLUR_LENGTHS, BLUR_DEGREES, GLARE_SPOTS = (9, 21), 30.0, (1, 3)


def augmented(image: np.ndarray, kind: str, rng: np.random.Generator) -> np.ndarray:
    """A copy with ``motion`` blur or ``glare`` of random size."""
    if kind == "motion":
        low, high = BLUR_LENGTHS
        return motion_blur(image, low + 2 * int(rng.integers(0, (high - low) // 2 + 1)), float(rng.uniform(-BLUR_DEGREES, BLUR_DEGREES)))
    if kind == "glare":
        spots = [(float(rng.uniform(0.1, 0.9)), float(rng.uniform(0.1, 0.9)), float(rng.uniform(0.05, 0.25))) for _ in range(int(rng.integers(GLARE_SPOTS[0], GLARE_SPOTS[1] + 1)))]
        return glare(image, spots, float(rng.uniform(0.5, 0.9)))
    raise ValueError(f"unknown kind {kind!r}")


@udtf(returnType="copy_idx int, height int, width int, data binary")
class AugmentedCopies:
    """Table function over (key, kind, n, height, width, channels, data): n copies with ``motion`` blur or ``glare``, the same ones in every run."""

    def eval(self, key: str, kind: str, n: int, height: int, width: int, channels: int, data: bytes) -> Iterator[tuple]:
        if data is not None:
            image = to_array(height, width, channels, data)
            for i in range(n):
                made = augmented(image, kind, copy_parameters(key, i))
                yield i, made.shape[0], made.shape[1], np.ascontiguousarray(made).tobytes()


@lru_cache(maxsize=8)
def lens_maps(width: int, height: int, strength: str) -> tuple[np.ndarray, np.ndarray]:
    """Source pixel of each target pixel under lens distortion, kept per worker."""
    from tagloom.functions.geometry import FOCAL, LENS

    k1, k2 = LENS[strength]
    f = max(width, height) * FOCAL
    y, x = np.mgrid[0:height, 0:width].astype(float)
    u, v = (x - width / 2) / f, (y - height / 2) / f
    target = np.hypot(u, v)
    t = target.copy()
    for _ in range(20):  # Newton steps for t (1 + k1 t^2 + k2 t^4) = target
        t = t - (t * (1 + k1 * t**2 + k2 * t**4) - target) / np.where(np.abs(d := 1 + 3 * k1 * t**2 + 5 * k2 * t**4) < 1e-6, 1e-6, d)
    scale = np.where(target > 1e-8, np.tan(np.clip(t, 0, 1.5)) / np.maximum(target, 1e-8), 1.0)
    return np.clip(np.rint(u * scale * f + width / 2), 0, width - 1).astype(int), np.clip(np.rint(v * scale * f + height / 2), 0, height - 1).astype(int)


def lens_distorted(image: np.ndarray, strength: str = "medium") -> np.ndarray:
    xs, ys = lens_maps(image.shape[1], image.shape[0], strength)
    return image[ys, xs]


def read_crops(picked: DataFrame, load: Callable[[], Callable[[bytes], str]], keys: list[str], crop: str = "crop") -> DataFrame:
    """(keys, raw): what a reader says about each crop. ``load`` runs once per task and gives the reader."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = load()
        for p in parts:
            yield p[keys].assign(raw=[None if c is None else reader(bytes(c)) for c in p[crop]])

    types = dict(picked.dtypes)
    return picked.select(*keys, crop).mapInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", raw string")


def decode_first(frames: DataFrame, load: Callable[[], Callable[[bytes], Iterator[tuple[str, str]]]], keys: list[str], accept: Callable[[str], bool], seq: str = "seq", crop: str = "crop") -> DataFrame:
    """(keys, seq, variant_name, text): attempts of each group in order up to the first accepted one.

    A decoder yields (variant, text) for a crop; later frames and variants
    aren't tried after a success.  Groups are tracks.
    """
    types = dict(frames.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + f", {seq} {types[seq]}, variant_name string, text string"

    def run(part: pd.DataFrame) -> pd.DataFrame:
        decode, rows = load(), []
        part = part.sort_values(seq)
        head = [part[k].iloc[0] for k in keys]
        for s, c in zip(part[seq], part[crop]):
            for name, text in decode(bytes(c)) if c is not None else ():
                rows.append((*head, s, name, text))
                if accept(text):
                    return pd.DataFrame(rows, columns=[*keys, seq, "variant_name", "text"])
        return pd.DataFrame(rows, columns=[*keys, seq, "variant_name", "text"])

    return frames.select(*keys, seq, crop).groupBy(*keys).applyInPandas(run, schema)
