"""Decoders for the frame source, and readers of codes.

``tagloom.sources.decoders:y4m`` reads uncompressed YUV4MPEG2 files and needs
numpy only.  ``opencv`` and the readers use libraries that may not be there;
they are imported when they are asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from tagloom.kernels import Reader, to_bytes

Frame = tuple[int, int, int, bytes]


def _open(path: str):
    """A file by path, or by an address that Arrow's file systems know."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, at = fs.FileSystem.from_uri(path)
        return system.open_input_file(at)
    return fs.LocalFileSystem().open_input_file(path)


class _Y4m:
    """Header and layout of an open YUV4MPEG2 file."""

    # Samples of a chroma plane by the colour space's name, as divisors of width and height; none: grey.
    PLANES = {"420": (2, 2), "422": (2, 1), "444": (1, 1), "mono": None}

    def __init__(self, file):
        self.file = file
        head = self._line(0)
        parts = head.split(" ")
        if parts[0] != "YUV4MPEG2":
            raise ValueError("no YUV4MPEG2 file")
        said = {p[0]: p[1:] for p in parts[1:] if p}
        self.width, self.height = int(said["W"]), int(said["H"])
        rate, per = said.get("F", "25:1").split(":")
        self.frame_ms = 1000 * int(per) / int(rate)
        space = said.get("C", "420")
        kind = next((k for k in self.PLANES if space.startswith(k)), None)
        if kind is None or "p1" in space:
            raise ValueError(f"colour space {space!r} isn't known")
        self.chroma = self.PLANES[kind]
        self.sizes = [(self.height, self.width)]
        if self.chroma:
            self.sizes += [(-(-self.height // self.chroma[1]), -(-self.width // self.chroma[0]))] * 2
        self.length = sum(h * w for h, w in self.sizes)
        self.start = len(head) + 1

    def _line(self, at: int) -> str:
        self.file.seek(at)
        out = b""
        while b"\n" not in out:
            more = self.file.read(80)
            if not more:
                break
            out += more
        return out.split(b"\n", 1)[0].decode("latin-1")

    def frames(self) -> Iterator[Frame]:
        at = self.start
        while (head := self._line(at)).startswith("FRAME"):
            self.file.seek(at + len(head) + 1)
            data = self.file.read(self.length)
            if len(data) < self.length:
                raise ValueError("the last frame isn't whole")
            yield self.height, self.width, 3 if self.chroma else 1, self._image(data)
            at += len(head) + 1 + self.length

    def _image(self, data: bytes) -> bytes:
        """Blue, green, red of a frame (BT.601, 16 to 235), or its luma as it is."""
        planes, at = [], 0
        for h, w in self.sizes:
            planes.append(np.frombuffer(data, np.uint8, h * w, at).reshape(h, w))
            at += h * w
        if not self.chroma:
            return planes[0].tobytes()
        dx, dy = self.chroma
        y = 1.164383 * (planes[0].astype(np.float64) - 16)
        u, v = (np.repeat(np.repeat(p, dy, axis=0), dx, axis=1)[: self.height, : self.width].astype(np.float64) - 128 for p in planes[1:])
        return to_bytes(np.stack([y + 2.017232 * u, y - 0.391762 * u - 0.812968 * v, y + 1.596027 * v], axis=2)).tobytes()

    def sought(self) -> tuple[int, Callable[[int], Frame | None]]:
        """Duration in ms, and the frame that is shown at a time. Frames have plain headers in a file that can be sought."""
        step = len("FRAME\n") + self.length
        number = (self.file.size() - self.start) // step

        def at(ts: int) -> Frame | None:
            n = int(ts / self.frame_ms + 1e-9)
            if not 0 <= n < number or self._line(self.start + n * step) != "FRAME":
                return None
            self.file.seek(self.start + n * step + len("FRAME\n"))
            return self.height, self.width, 3 if self.chroma else 1, self._image(self.file.read(self.length))

        return int(number * self.frame_ms), at


def y4m(path: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(ts_ms, height, width, channels, bytes) of all frames."""
    with _open(path) as file:
        video = _Y4m(file)
        for n, frame in enumerate(video.frames()):
            yield int(n * video.frame_ms + 1e-9), *frame


def _y4m_span(path: str, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    with _open(path) as file:
        video = _Y4m(file)
        duration, at = video.sought()
        step = len("FRAME\n") + video.length
        number, rest = divmod(file.size() - video.start, step)
        for n in range(max(0, int(low / video.frame_ms) - 1), number):
            ts = int(n * video.frame_ms + 1e-9)
            if ts >= high:
                return
            if ts >= low:
                frame = at(n * video.frame_ms)
                if frame is None:
                    raise ValueError("frames with parameters can't be sought")
                yield n + 1, ts, *frame
        if rest and high > duration:
            raise ValueError("the last frame isn't whole")


y4m.seek = lambda path: _Y4m(_open(path)).sought()
y4m.span = _y4m_span


def opencv(path: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """All frames of any video that OpenCV reads."""
    import cv2

    video = cv2.VideoCapture(path)
    if not video.isOpened():
        raise OSError(f"cannot open {path}")
    try:
        while True:
            ok, image = video.read()
            if not ok:
                return
            yield int(video.get(cv2.CAP_PROP_POS_MSEC)), image.shape[0], image.shape[1], 3, image.tobytes()
    finally:
        video.release()


def _opencv_sought(path: str) -> tuple[int, Callable[[int], Frame | None]]:
    import cv2

    video = cv2.VideoCapture(path)
    if not video.isOpened():
        raise OSError(f"cannot open {path}")

    def at(ts: int) -> Frame | None:
        video.set(cv2.CAP_PROP_POS_MSEC, ts)
        ok, image = video.read()
        return (image.shape[0], image.shape[1], 3, image.tobytes()) if ok else None

    return int(1000 * video.get(cv2.CAP_PROP_FRAME_COUNT) / max(1.0, video.get(cv2.CAP_PROP_FPS))), at


opencv.seek = _opencv_sought


def code_readers() -> list[tuple[str, Reader]]:
    """The readers of codes whose libraries are there, in the order in which they are asked: zxing, cv2."""
    out: list[tuple[str, Reader]] = []
    try:
        import zxingcpp

        out.append(("zxing", lambda image: [(r.format.name, r.text) for r in zxingcpp.read_barcodes(image)]))
    except ImportError:
        pass
    try:
        import cv2

        square = cv2.QRCodeDetector()
        out.append(("cv2", lambda image: [("QRCode", square.detectAndDecode(image)[0])]))
    except ImportError:
        pass
    return out
