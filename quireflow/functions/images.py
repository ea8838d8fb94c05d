"""Pixel functions that need no image library: arrays of height x width x 3 bytes; for use within model slots."""

from __future__ import annotations

import numpy as np

PAPER = (245, 242, 232)
Rect = tuple[int, int, int, int]


def paper_colour(image: np.ndarray) -> tuple[int, int, int]:
    """The colour of the paper: of a strip near the border (from 1 % of the shorter side in, 4 % wide) the lighter 60 % by mean of the channels, then the median of each channel.
    A light cream for images under 8 pixels."""
    h, w = image.shape[:2]
    if min(h, w) < 8:
        return PAPER
    inset, band = max(1, int(min(h, w) * 0.01)), max(2, int(min(h, w) * 0.04))
    near = lambda n: slice(inset, min(n, inset + band))
    far = lambda n: slice(max(0, n - inset - band), max(0, n - inset))
    long_w, long_h = slice(inset, w - inset), slice(inset, h - inset)
    strips = [image[a, b].reshape(-1, 3) for a, b in ((near(h), long_w), (far(h), long_w), (long_h, near(w)), (long_h, far(w)))]
    pixels = np.concatenate([s for s in strips if s.size] or [np.zeros((0, 3), np.uint8)])
    if not len(pixels):
        return PAPER
    light = pixels.astype(np.float32).mean(axis=1)
    kept = pixels[light >= np.percentile(light, 40)]
    return tuple(int(v) for v in np.median(kept.astype(np.float32), axis=0))


def painted(image: np.ndarray, rects: list[Rect], protected: list[Rect] = (), colour: tuple[int, int, int] | None = None) -> np.ndarray:
    """The image with rectangles in the colour of its paper, but for what lies in protected ones; itself if there is nothing to paint."""
    if not rects:
        return image
    out = image.copy()
    for x1, y1, x2, y2 in rects:
        out[max(0, y1) : y2, max(0, x1) : x2] = colour or paper_colour(image)
    for x1, y1, x2, y2 in protected:
        out[max(0, y1) : y2, max(0, x1) : x2] = image[max(0, y1) : y2, max(0, x1) : x2]
    return out


def cropped(image: np.ndarray, rect: Rect, margin: int, blank: list[Rect] = (), colour: tuple[int, int, int] | None = None) -> np.ndarray:
    """A rectangle of the image in the middle of a canvas in the colour of the paper, ``margin`` pixels wider at each side even beyond the page; ``blank`` rectangles are painted over."""
    colour = colour or paper_colour(image)
    (x1, y1, x2, y2), m = rect, max(0, margin)
    canvas = np.empty((max(1, y2 - y1 + 2 * m), max(1, x2 - x1 + 2 * m), 3), np.uint8)
    canvas[:] = colour
    h, w = image.shape[:2]
    a, b, c, d = max(0, x1), max(0, y1), min(w, x2), min(h, y2)
    if c > a and d > b:
        canvas[b - y1 + m : d - y1 + m, a - x1 + m : c - x1 + m] = image[b:d, a:c]
    for x, y, p, q in blank:
        if (x, y, p, q) != tuple(rect):
            canvas[max(0, y - y1 + m) : max(0, q - y1 + m), max(0, x - x1 + m) : max(0, p - x1 + m)] = colour
    return canvas
