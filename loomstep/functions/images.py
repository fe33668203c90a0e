"""Steps on stacks of images, as numpy arrays [images, height, width, channels] of bytes or of numbers from 0 to 1.

Each step takes a stack and a number in [0, 1) drawn for it, and gives a stack; the views of a sample go through a step
together, so they share what is drawn. Decoding is not done here: images come as their pixels.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Step = Callable[[np.ndarray, float], np.ndarray]
# What the eye makes of red, green and blue.
LUMA = (0.2989, 0.587, 0.114)


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    x = np.abs(x)
    near, far = ((a + 2) * x - (a + 3)) * x * x + 1, (((x - 5) * x + 8) * x - 4) * a
    return np.where(x < 1, near, np.where(x < 2, far, 0))


#: Kernels with the distance at which they end. Enlarging samples them, reducing stretches them.
KERNELS: dict[str, tuple[Callable[[np.ndarray], np.ndarray], float]] = {
    "box": (lambda x: ((x > -0.5) & (x <= 0.5)).astype(float), 0.5),
    "bilinear": (lambda x: np.maximum(0, 1 - np.abs(x)), 1.0),
    "hamming": (lambda x: np.where(np.abs(x) < 1, np.sinc(x) * (0.54 + 0.46 * np.cos(np.pi * x)), 0), 1.0),
    "bicubic": (_cubic, 2.0),
    "lanczos": (lambda x: np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0), 3.0),
}
NEAREST = ("nearest", "nearest_exact")


def weights(size: int, to: int, method: str) -> np.ndarray:
    """to x size: what each new place takes of each old one along one side; rows add up to one."""
    scale = size / to
    centre = (np.arange(to) + 0.5) * scale
    if method in NEAREST:
        at = np.minimum(np.floor(centre if method == "nearest_exact" else np.arange(to) * scale).astype(int), size - 1)
        return (np.arange(size) == at[:, None]).astype(float)
    kernel, _ = KERNELS[method]
    w = kernel((np.arange(size) + 0.5 - centre[:, None]) / max(scale, 1.0))
    return w / w.sum(axis=1, keepdims=True)


def resized(images: np.ndarray, height: int, width: int, method: str = "bilinear") -> np.ndarray:
    """Along the width, then along the height; bytes are rounded after each."""
    if images.shape[1:3] == (height, width):
        return images

    def cut(x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(x + 0.5), 0, 255) if images.dtype == np.uint8 else x

    out = cut(np.einsum("ow,nhwc->nhoc", weights(images.shape[2], width, method), images.astype(float)))
    return cut(np.einsum("oh,nhwc->nowc", weights(images.shape[1], height, method), out)).astype(images.dtype)


def resize(height: int, width: int, method: str = "bilinear") -> Step:
    return lambda x, u: resized(x, height, width, method)


def crop(scale: float, training: bool) -> Step:
    """A window of ``scale`` of each side: at a drawn place in training, in the middle else."""

    def run(x: np.ndarray, u: float) -> np.ndarray:
        h, w = int(x.shape[1] * scale), int(x.shape[2] * scale)
        rows, columns = x.shape[1] - h, x.shape[2] - w
        if training:
            place = int(u * (rows + 1) * (columns + 1))
            top, left = divmod(place, columns + 1)
        else:
            top, left = round(rows / 2), round(columns / 2)
        return x[:, top : top + h, left : left + w]

    return run


def sometimes(step: Step, p: float) -> Step:
    """The step with probability ``p``; what is left of the drawn number goes on to it."""
    return lambda x, u: step(x, u / p) if u < p else x


def flip(x: np.ndarray, u: float) -> np.ndarray:
    return x[:, :, ::-1]


def gray(x: np.ndarray, u: float) -> np.ndarray:
    """Brightness in all three channels; bytes are cut down."""
    one = (x.astype(float) * LUMA).sum(axis=3, keepdims=True)
    return np.repeat(np.floor(one + 1e-9) if x.dtype == np.uint8 else one, 3, axis=3).astype(x.dtype)


def posterize(bits: int) -> Step:
    """Only the highest bits of each byte."""
    return lambda x, u: x & np.uint8(256 - (1 << (8 - bits)))


def letterbox(height: int, width: int, method: str = "bilinear") -> Step:
    """As large as fits without distortion, in the middle of zeros."""

    def run(x: np.ndarray, u: float) -> np.ndarray:
        if x.shape[1:3] == (height, width):
            return x
        ratio = max(x.shape[2] / width, x.shape[1] / height)
        inner = resized(x, int(x.shape[1] / ratio), int(x.shape[2] / ratio), method)
        out = np.zeros((len(x), height, width, x.shape[3]), x.dtype)
        top, left = int((height - inner.shape[1]) / 2), int((width - inner.shape[2]) / 2)
        out[:, top : top + inner.shape[1], left : left + inner.shape[2]] = inner
        return out

    return run


def patch_sizes(height: int, width: int, target: int, pad: bool, patch: int = 14) -> tuple[int, int]:
    """(height, width) after resizing: the longer side (with ``pad``) or the width is the target, the other one a multiple of
    the patch."""
    if pad and height > width:
        return target, round(width * (target / height) / patch) * patch
    return round(height * (target / width) / patch) * patch, target


def patched(images: list[np.ndarray], target: int, pad: bool, patch: int = 14) -> np.ndarray:
    """Single images [height, width, channels] of bytes as one stack [images, channels, height, width] from 0 to 1: resized by
    :func:`patch_sizes`, cut in the middle to the target's height, or filled up with white to a square, and then, where sizes
    still differ, filled up with white to the largest."""

    def white(x: np.ndarray, h: int, w: int) -> np.ndarray:
        rows, columns = h - x.shape[0], w - x.shape[1]
        return np.pad(x, ((rows // 2, rows - rows // 2), (columns // 2, columns - columns // 2), (0, 0)), constant_values=1.0)

    out = []
    for x in images:
        h, w = patch_sizes(x.shape[0], x.shape[1], target, pad, patch)
        y = resized(x[None], h, w, "bicubic")[0] / 255.0
        if not pad and h > target:
            y = y[(h - target) // 2 :][:target]
        out.append(white(y, target, target) if pad else y)
    h, w = max(y.shape[0] for y in out), max(y.shape[1] for y in out)
    return np.stack([white(y, h, w) for y in out]).transpose(0, 3, 1, 2)


def to_unit(x: np.ndarray, height: int | None = None, width: int | None = None) -> np.ndarray:
    """Bytes [images, height, width, channels] as numbers [images, channels, height, width] from 0 to 1; a resolution, if one
    is given, must be theirs."""
    if height is not None and x.shape[1:3] != (height, width):
        raise ValueError(f"images are {x.shape[1:3]}, not {(height, width)}")
    return (x / np.float32(255)).astype(np.float32).transpose(0, 3, 1, 2)


def to_bytes(x: np.ndarray) -> np.ndarray:
    """The way back; what is behind the point is cut off."""
    return (x.transpose(0, 2, 3, 1) * 255).astype(np.uint8)


def as_bytes(x: np.ndarray, rounded: bool = False) -> np.ndarray:
    """Numbers from 0 to 1 as bytes, cut off or rounded; bytes as they are."""
    if x.dtype == np.uint8:
        return x
    y = np.clip(x.astype(float), 0, 1) * 255
    return (np.floor(y + 0.5) if rounded else y).astype(np.uint8)
