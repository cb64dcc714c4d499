"""Image codecs: portable pixmaps by numpy alone, and JPEG and the rest where a library is installed."""

from __future__ import annotations

import io
import re
from collections.abc import Sequence
from importlib.util import find_spec

import numpy as np

# A colour for each detector's polygons (red, green, blue), and white for the boxes that stay.
DETECTOR_COLOURS = ((118, 255, 3), (100, 221, 23))
BOX_COLOUR = (255, 255, 255)

_HEADER = re.compile(rb"P6(?:\s+(?:#[^\n]*\n)?)+(\d+)(?:\s+(?:#[^\n]*\n)?)+(\d+)(?:\s+(?:#[^\n]*\n)?)+255\s")


def _line(image: np.ndarray, a: Sequence[float], b: Sequence[float], colour: Sequence[int], width: int) -> None:
    n = int(max(abs(b[0] - a[0]), abs(b[1] - a[1]))) + 1
    xs, ys = np.rint(np.linspace(a[0], b[0], n + 1)).astype(int), np.rint(np.linspace(a[1], b[1], n + 1)).astype(int)
    for dx in range(width):
        for dy in range(width):
            x, y = xs + dx, ys + dy
            inside = (x >= 0) & (y >= 0) & (x < image.shape[1]) & (y < image.shape[0])
            image[y[inside], x[inside]] = colour


def drawn(image: np.ndarray, polygons: Sequence[Sequence[Sequence[tuple[float, float]]]], boxes: Sequence[tuple[float, float, float, float, float]]) -> np.ndarray:
    """A copy of a height x width x 3 image with each detector's polygons in thin lines of its colour, and boxes in thick white ones."""
    out = image.copy()
    for det, shapes in enumerate(polygons):
        for shape in shapes:
            for a, b in zip(shape, [*shape[1:], shape[0]], strict=True):
                _line(out, a, b, DETECTOR_COLOURS[det % len(DETECTOR_COLOURS)], 1)
    for x1, y1, x2, y2, _ in boxes:
        corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]
        for a, b in zip(corners, [*corners[1:], corners[0]], strict=True):
            _line(out, a, b, BOX_COLOUR, 2)
    return out


class PixmapCodec:
    """Binary portable pixmaps (P6) of 8 bits."""

    def decode(self, data: bytes) -> np.ndarray | None:
        head = _HEADER.match(data)
        if head is None:
            return None
        width, height = int(head[1]), int(head[2])
        pixels = np.frombuffer(data, np.uint8, offset=head.end())
        return pixels[: width * height * 3].reshape(height, width, 3) if width and height and len(pixels) >= width * height * 3 else None

    def size(self, image: np.ndarray) -> tuple[int, int]:
        return image.shape[1], image.shape[0]

    def encode(self, image: np.ndarray) -> bytes | None:
        return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + np.ascontiguousarray(image).tobytes() if image.size else None

    def crop(self, image: np.ndarray, left: int, top: int, right: int, bottom: int) -> bytes | None:
        return self.encode(image[top:bottom, left:right])

    def overlay(self, image: np.ndarray, polygons, boxes) -> bytes | None:
        return self.encode(drawn(image, polygons, boxes))


class PillowCodec(PixmapCodec):
    """What Pillow decodes; crops are JPEG of the given quality."""

    def __init__(self, quality: int = 90):
        self.quality = quality

    def decode(self, data: bytes) -> np.ndarray | None:
        from PIL import Image

        try:
            return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))
        except Exception:
            return None

    def encode(self, image: np.ndarray) -> bytes | None:
        from PIL import Image

        if not image.size:
            return None
        out = io.BytesIO()
        Image.fromarray(np.ascontiguousarray(image)).save(out, "JPEG", quality=self.quality)
        return out.getvalue()


class OpenCvCodec(PixmapCodec):
    """What OpenCV decodes; crops are JPEG of the given quality. Images are red, green, blue here as elsewhere."""

    def __init__(self, quality: int = 90):
        self.quality = quality

    def decode(self, data: bytes) -> np.ndarray | None:
        import cv2

        cv2.setNumThreads(0)
        image = cv2.imdecode(np.frombuffer(data, np.uint8), cv2.IMREAD_COLOR)
        return None if image is None else image[:, :, ::-1]

    def encode(self, image: np.ndarray) -> bytes | None:
        import cv2

        done, out = cv2.imencode(".jpg", np.ascontiguousarray(image[:, :, ::-1]), [cv2.IMWRITE_JPEG_QUALITY, self.quality]) if image.size else (False, None)
        return out.tobytes() if done else None


def installed(quality: int = 90) -> PixmapCodec | None:
    """OpenCV's codec, else Pillow's, if one is installed."""
    return OpenCvCodec(quality) if find_spec("cv2") else PillowCodec(quality) if find_spec("PIL") else None
