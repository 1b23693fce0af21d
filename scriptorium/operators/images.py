"""Pixels: PNG in and out, outlines to coverage, the degradation stages (NumPy)."""

from __future__ import annotations

import functools
import math
import struct
import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np


class StageError(ValueError):
    pass


def png_encode(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rgb.astype(np.uint8).reshape(h, w * 3)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


#: Samples of a pixel by PNG colour type.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfilter(raw: np.ndarray, bpp: int) -> np.ndarray:
    """Rows of bytes without their filter bytes and filters."""
    out = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(raw.shape[1] - 1, np.uint8)
    for y, (kind, line) in enumerate(zip(raw[:, 0].tolist(), raw[:, 1:])):
        if kind == 0:
            now = line
        elif kind == 1:  # differences from the left: running sums, byte by byte of a pixel
            now = np.concatenate([line, np.zeros(-len(line) % bpp, np.uint8)]).reshape(-1, bpp).cumsum(axis=0, dtype=np.uint8).ravel()[: len(line)]
        elif kind == 2:
            now = line + above
        elif kind in (3, 4):
            now = _along(line.tolist(), above.tolist(), bpp, kind == 4)
        else:
            raise StageError(f"PNG: filter {kind} is unknown")
        out[y] = above = now
    return out


def _along(line: list[int], above: list[int], bpp: int, paeth: bool) -> np.ndarray:
    """The two filters that look at the byte to the left as it comes out."""
    out = bytearray(len(line))
    for i, v in enumerate(line):
        left, up = (out[i - bpp] if i >= bpp else 0), above[i]
        if paeth:
            corner = above[i - bpp] if i >= bpp else 0
            near = left + up - corner
            guess = min((left, up, corner), key=lambda x: abs(near - x))
        else:
            guess = (left + up) >> 1
        out[i] = (v + guess) & 255
    return np.frombuffer(bytes(out), np.uint8)


def png_decode(data: bytes) -> np.ndarray:
    """RGB of a PNG of any colour type and depth; alpha is left out, interlacing refused."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise StageError("not a PNG")
    at, body, palette, head = 8, b"", None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    if head is None or head[3] not in _SAMPLES or head[6]:
        raise StageError("PNG: interlaced or without a head")
    w, h, depth, colour = head[:4]
    samples = _SAMPLES[colour]
    row = -(-w * samples * depth // 8)
    try:
        raw = np.frombuffer(zlib.decompress(body), np.uint8)[: h * (row + 1)].reshape(h, row + 1)
    except (zlib.error, ValueError) as e:
        raise StageError(f"PNG: {e}") from e
    lines = _unfilter(raw, max(1, samples * depth // 8))
    if depth == 16:
        lines = lines[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(lines, axis=1).reshape(h, -1, depth)
        lines = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2).astype(np.uint8)
        if colour == 0:
            lines = lines * np.uint8(255 // ((1 << depth) - 1))
    px = lines[:, : w * samples].reshape(h, w, samples)
    if colour == 3:
        if palette is None or px.max(initial=0) >= len(palette):
            raise StageError("PNG: a colour isn't in the palette")
        return palette[px[..., 0]].copy()
    return np.repeat(px[..., :1], 3, axis=2) if colour in (0, 4) else px[..., :3].copy()


def bmp_decode(data: bytes) -> np.ndarray:
    """RGB of an uncompressed BMP of 24 or 32 bits a pixel."""
    if data[:2] != b"BM" or len(data) < 54:
        raise StageError("not a BMP")
    start, (w, h), bits, packed = struct.unpack("<I", data[10:14])[0], struct.unpack("<ii", data[18:26]), struct.unpack("<H", data[28:30])[0], struct.unpack("<I", data[30:34])[0]
    if bits not in (24, 32) or packed not in (0, 3):
        raise StageError("BMP: only 24 and 32 bits without compression")
    row = -(-w * bits // 32) * 4
    px = np.frombuffer(data, np.uint8, row * abs(h), start).reshape(abs(h), row)[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[..., 2::-1]
    return (px[::-1] if h > 0 else px).copy()


#: Suffixes of images in a texture folder, and the readers that need no codec.
TEXTURES = (".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tiff", ".tif")
DECODERS: dict[str, Callable[[bytes], np.ndarray]] = {".png": png_decode, ".bmp": bmp_decode}


def list_textures(folder: str | None) -> list[Path]:
    """The images of a texture folder by name; those that need a codec are refused by name."""
    if not folder:
        raise StageError("paper_texture: no directory")
    if not Path(folder).is_dir():
        raise StageError(f"paper_texture: {folder} isn't a folder")
    found = sorted(p for p in Path(folder).iterdir() if p.suffix.lower() in TEXTURES)
    if not found:
        raise StageError(f"paper_texture: no image in {folder}")
    odd = [p.name for p in found if p.suffix.lower() not in DECODERS]
    if odd:
        raise StageError(f"paper_texture: no codec for {', '.join(odd)}; textures are PNG or BMP")
    return found


@functools.lru_cache(maxsize=16)
def texture_of(name: str) -> np.ndarray:
    """A texture that Spark sent to this machine, decoded."""
    from pyspark import SparkFiles

    path = Path(SparkFiles.get(name))
    return DECODERS[path.suffix](path.read_bytes())


# ------------------------------------------------------------- glyphs


class Outlines:
    """Glyph outlines of a TrueType file: contours of points by code point."""

    def __init__(self, data: bytes):
        from .coverage import _cmap, _tables

        t = _tables(data)
        self.glyf, self.cmap = t["glyf"], _cmap(t["cmap"])
        self.em = struct.unpack(">H", t["head"][18:20])[0]
        long_ = struct.unpack(">h", t["head"][50:52])[0]
        n = struct.unpack(">H", t["maxp"][4:6])[0]
        self.loca = struct.unpack(f">{n + 1}I", t["loca"][: 4 * n + 4]) if long_ else [2 * x for x in struct.unpack(f">{n + 1}H", t["loca"][: 2 * n + 2])]
        wide = struct.unpack(">H", t["hhea"][34:36])[0]
        self.ascent, self.descent = struct.unpack(">hh", t["hhea"][4:8])
        self.widths = [struct.unpack(">H", t["hmtx"][4 * i : 4 * i + 2])[0] for i in range(wide)]

    def advance(self, char: str) -> int:
        return self.widths[min(self.cmap[ord(char)], len(self.widths) - 1)]

    def contours(self, glyph: int, depth: int = 0) -> list[np.ndarray]:
        a, b = self.loca[glyph], self.loca[glyph + 1]
        if a == b or depth > 5:
            return []
        data = self.glyf[a:b]
        n = struct.unpack(">h", data[:2])[0]
        return self._simple(data, n) if n >= 0 else self._composite(data, depth)

    def _simple(self, data: bytes, n: int) -> list[np.ndarray]:
        ends = struct.unpack(f">{n}H", data[10 : 10 + 2 * n])
        at = 12 + 2 * n + struct.unpack(">H", data[10 + 2 * n : 12 + 2 * n])[0]
        total = ends[-1] + 1 if ends else 0
        flags: list[int] = []
        while len(flags) < total:
            f = data[at]
            at += 1
            times = 1
            if f & 8:
                times += data[at]
                at += 1
            flags += [f] * times
        axes = []
        for short, same in ((2, 16), (4, 32)):
            value, out = 0, []
            for f in flags:
                if f & short:
                    value += data[at] if f & same else -data[at]
                    at += 1
                elif not f & same:
                    value += struct.unpack(">h", data[at : at + 2])[0]
                    at += 2
                out.append(value)
            axes.append(out)
        result, start = [], 0
        for end in ends:
            pts = [(axes[0][i], axes[1][i], bool(flags[i] & 1)) for i in range(start, end + 1)]
            start = end + 1
            if len(pts) > 1:
                result.append(_flatten(pts))
        return result

    def _composite(self, data: bytes, depth: int) -> list[np.ndarray]:
        out, at, more = [], 10, True
        while more:
            flags, glyph = struct.unpack(">HH", data[at : at + 4])
            at += 4
            dx, dy = struct.unpack(">hh" if flags & 1 else ">bb", data[at : at + (4 if flags & 1 else 2)])
            at += 4 if flags & 1 else 2
            m = np.eye(2)
            f = lambda k: struct.unpack(">h", data[at + 2 * k : at + 2 * k + 2])[0] / 16384  # noqa: B023, E731
            if flags & 8:
                m, at = np.eye(2) * f(0), at + 2
            elif flags & 64:
                m, at = np.diag([f(0), f(1)]), at + 4
            elif flags & 128:
                m, at = np.array([[f(0), f(1)], [f(2), f(3)]]), at + 8
            move = np.array([dx, dy]) if flags & 2 else np.zeros(2)
            out += [c @ m + move for c in self.contours(glyph, depth + 1)]
            more = bool(flags & 32)
        return out


def _flatten(pts: list[tuple[int, int, bool]], steps: int = 6) -> np.ndarray:
    """A closed contour of quadratic curves as a polygon."""
    whole = []
    for i, (x, y, on) in enumerate(pts):
        px, py, pon = pts[i - 1]
        if not on and not pon:
            whole.append(((x + px) / 2, (y + py) / 2, True))
        whole.append((x, y, on))
    first = next((i for i, p in enumerate(whole) if p[2]), 0)
    whole = whole[first:] + whole[:first]
    out, i, n = [], 0, len(whole)
    while i < n:
        x, y, on = whole[i]
        if on:
            out.append((x, y))
        else:
            (ax, ay), (bx, by, _) = out[-1], whole[(i + 1) % n]
            for k in range(1, steps):
                t = k / steps
                out.append(((1 - t) ** 2 * ax + 2 * t * (1 - t) * x + t * t * bx, (1 - t) ** 2 * ay + 2 * t * (1 - t) * y + t * t * by))
        i += 1
    return np.array(out, dtype=np.float64)


def rasterize(contours: list[np.ndarray], scale: float, sub: int = 4) -> tuple[np.ndarray, int, int]:
    """(coverage in [0, 1], left, top) of an outline; y grows downwards, top is negative
    above the base line.  Non-zero winding on ``sub`` scan lines a pixel."""
    if not contours:
        return np.zeros((0, 0)), 0, 0
    scaled = [np.stack([c[:, 0] * scale, -c[:, 1] * scale], axis=1) for c in contours]
    every = np.concatenate(scaled)
    x0, y0 = np.floor(every.min(axis=0)).astype(int)
    x1, y1 = np.ceil(every.max(axis=0)).astype(int)
    w, h = max(1, x1 - x0), max(1, y1 - y0)
    a = np.concatenate(scaled)
    b = np.concatenate([np.roll(c, -1, axis=0) for c in scaled])
    out = np.zeros((h, w))
    edges = np.arange(w + 1) + x0
    for row in range(h * sub):
        y = y0 + (row + 0.5) / sub
        up, down = (a[:, 1] <= y) & (b[:, 1] > y), (b[:, 1] <= y) & (a[:, 1] > y)
        hit = up | down
        if not hit.any():
            continue
        xs = a[hit, 0] + (y - a[hit, 1]) / (b[hit, 1] - a[hit, 1]) * (b[hit, 0] - a[hit, 0])
        turn = np.where(up[hit], 1, -1)
        order = np.argsort(xs, kind="stable")
        xs, inside = xs[order], np.cumsum(turn[order]) != 0
        for k in np.flatnonzero(inside[:-1]):
            lo, hi = np.clip([xs[k], xs[k + 1]], x0, x1)
            out[row // sub] += np.clip(np.minimum(edges[1:], hi) - np.maximum(edges[:-1], lo), 0, None) / sub
    return np.clip(out, 0, 1), int(x0), int(y0)


# ------------------------------------------------------------- stages


def _filtered(rgb: np.ndarray, kernel: np.ndarray, axis: int) -> np.ndarray:
    half, n = len(kernel) // 2, rgb.shape[axis]
    wide = np.take(rgb, np.arange(-half, n + half).clip(0, n - 1), axis=axis)
    part = (lambda i: wide[i : i + n]) if axis == 0 else (lambda i: wide[:, i : i + n])
    out = kernel[0] * part(0)
    for i, k in enumerate(kernel[1:], 1):
        out += k * part(i)
    return out


def _gauss(sigma: float) -> np.ndarray:
    r = max(1, math.ceil(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return k / k.sum()


def _shifted(rgb: np.ndarray, dx: int, dy: int) -> np.ndarray:
    h, w = rgb.shape[:2]
    return rgb[np.clip(np.arange(h) + dy, 0, h - 1)][:, np.clip(np.arange(w) + dx, 0, w - 1)]


def blur(rgb, o, rng):
    kind, x = o.get("filter", "gaussian"), rgb.astype(float)
    if kind == "gaussian":
        sigma = _number(o.get("sigma", 1.0), rng)
        if sigma <= 0:
            return rgb
        # Grey on grey: one channel stands for all.
        grey = (rgb == rgb[..., :1]).all()
        out = _byte(_filtered(_filtered(x[..., :1] if grey else x, _gauss(sigma), 0), _gauss(sigma), 1))
        return np.repeat(out, 3, axis=2) if grey else out
    if kind == "motion":
        n, angle = int(_number(o.get("motion_length_px", 5), rng)), math.radians(_number(o.get("motion_angle_deg", 0.0), rng))
        if n <= 1:
            return rgb
        n += 1 - n % 2
        places = [(round(k * math.cos(angle)), round(-k * math.sin(angle))) for k in range(-(n // 2), n // 2 + 1)]
        return _byte(sum(_shifted(x, dx, dy) for dx, dy in places) / n)
    if kind == "defocus":
        r = int(round(_number(o.get("sigma", 1.0), rng)))
        k = np.ones(2 * r + 1) / (2 * r + 1)
        return rgb if r <= 0 else _byte(_filtered(_filtered(x, k, 0), k, 1))
    raise StageError(f"blur: filter {kind!r} is unknown")


def noise(rgb, o, rng):
    own = np.random.Generator(np.random.PCG64(int(rng.integers(1 << 62))))
    kind, x = o.get("noise_kind", "gaussian"), rgb.astype(float)
    if kind == "gaussian":
        return _byte(x + own.normal(0, _number(o.get("stddev", 8.0), rng), rgb.shape))
    if kind == "salt_pepper":
        half, u, out = _number(o.get("amount", 0.01), rng) / 2, own.random(rgb.shape[:2]), rgb.copy()
        out[u < half], out[u > 1 - half] = 0, 255
        return out
    if kind == "poisson":
        return _byte(own.poisson(x))
    if kind == "speckle":
        return _byte(x * (1 + own.normal(0, _number(o.get("stddev", 8.0), rng) / 255, rgb.shape)))
    raise StageError(f"noise: kind {kind!r} is unknown")


def brightness(rgb, o, rng):
    f = _number(o.get("factor", 1.0), rng)
    return rgb if f == 1 else _byte(rgb * f)


def contrast(rgb, o, rng):
    f = _number(o.get("factor", 1.0), rng)
    if f == 1:
        return rgb
    middle = round(float((rgb @ np.array([0.299, 0.587, 0.114])).mean()))
    return _byte(middle + (rgb.astype(float) - middle) * f)


def gamma(rgb, o, rng):
    g = _number(o.get("gamma", 1.0), rng)
    return rgb if g <= 0 or g == 1 else _byte(255 * (rgb / 255) ** (1 / g))


def _spread(pick: Callable):
    def stage(rgb, o, rng):
        k, times = int(_number(o.get("kernel_size_px", 1), rng)), int(_number(o.get("iterations", 1), rng))
        out = rgb
        for _ in range(max(0, times) if k > 0 else 0):
            for flat in ((1, 0), (0, 1)):
                out = pick.reduce([_shifted(out, d * flat[0], d * flat[1]) for d in range(-k, k + 1)])
        return out

    return stage


def blend_images(mode: str, base: np.ndarray, top: np.ndarray) -> np.ndarray:
    a, b = base / 255, top / 255
    mult, scr = a * b, 1 - (1 - a) * (1 - b)
    modes = {"multiply": mult, "screen": scr, "overlay": np.where(a <= 0.5, 2 * mult, 2 * scr - 1), "hard_light": np.where(b <= 0.5, 2 * mult, 2 * scr - 1)}
    if mode not in modes:
        raise StageError(f"blend mode {mode!r} is unknown")
    return modes[mode] * 255


def resized(rgb: np.ndarray, w: int, h: int) -> np.ndarray:
    """Bilinear, pixel centres on pixel centres."""
    y, x = ((np.arange(n) + 0.5) * m / n - 0.5 for n, m in ((h, rgb.shape[0]), (w, rgb.shape[1])))
    y, x = np.clip(y, 0, rgb.shape[0] - 1), np.clip(x, 0, rgb.shape[1] - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, rgb.shape[0] - 1), np.minimum(x0 + 1, rgb.shape[1] - 1)
    fy, fx, px = (y - y0)[:, None, None], (x - x0)[None, :, None], rgb.astype(float)
    return _byte((px[y0][:, x0] * (1 - fx) + px[y0][:, x1] * fx) * (1 - fy) + (px[y1][:, x0] * (1 - fx) + px[y1][:, x1] * fx) * fy)


def paper_texture(rgb, o, rng):
    """A random texture, scaled and turned on its own canvas, a random cut of it or, where it
    is smaller, tiles of it, blended in by the opacity.

    ``textures``: the names of files that Spark sent along, or decoded images.
    """
    k = min(1.0, _number(o.get("opacity", 0.5), rng))
    scale, angle = _number(o.get("scale", 1.0), rng), _number(o.get("rotate_deg", 0), rng)
    if k <= 0:
        return rgb
    textures = o.get("textures")
    if not textures:
        textures = [DECODERS[p.suffix.lower()](p.read_bytes()) for p in list_textures(o.get("directory"))]
    t = textures[int(rng.integers(len(textures)))]
    t = texture_of(t) if isinstance(t, str) else t
    if scale != 1:
        t = resized(t, max(1, round(t.shape[1] * scale)), max(1, round(t.shape[0] * scale)))
    if angle:
        full, (h, w) = rotate(t, angle, (0, 0, 0))[0], t.shape[:2]
        y, x = (full.shape[0] - h) // 2, (full.shape[1] - w) // 2
        t = full[max(0, y) : max(0, y) + h, max(0, x) : max(0, x) + w]
    h, w = rgb.shape[:2]
    if t.shape[0] < h or t.shape[1] < w:
        t = np.tile(t, (-(-h // t.shape[0]), -(-w // t.shape[1]), 1))[:h, :w]
    else:
        y, x = int(rng.integers(t.shape[0] - h + 1)), int(rng.integers(t.shape[1] - w + 1))
        t = t[y : y + h, x : x + w]
    return _byte(rgb * (1 - k) + blend_images(o.get("blend", "multiply"), rgb, t) * k)


def foxing(rgb, o, rng):
    h, w = rgb.shape[:2]
    out, colour = rgb.astype(float), np.array(o.get("color", [150, 110, 60]), float)
    yy, xx = np.mgrid[0:h, 0:w]
    for _ in range(int(_number(o.get("count", 5), rng))):
        r, k = max(1.0, _number(o.get("radius_px", 10), rng)), _number(o.get("opacity", 0.3), rng)
        cx, cy = rng.random() * w, rng.random() * h
        soft = np.clip(1 - (((xx - cx) / r) ** 2 + ((yy - cy) / (r * (0.6 + 0.4 * rng.random()))) ** 2), 0, 1)[..., None] * k
        out = out * (1 - soft) + colour * soft
    return _byte(out)


def grayscale(rgb, o, rng):
    method = o.get("method", "luminosity")
    x = rgb.astype(float)
    if method == "luminosity":
        g = x @ np.array([0.299, 0.587, 0.114])
    elif method == "average":
        g = x.mean(axis=2)
    elif method in ("red", "green", "blue"):
        g = x[..., ("red", "green", "blue").index(method)]
    else:
        raise StageError(f"grayscale: method {method!r} is unknown")
    return np.repeat(_byte(g)[..., None], 3, axis=2)


#: The luminance and chrominance tables of the JPEG standard's annex K.
_LUMA = np.array([[16, 11, 10, 16, 24, 40, 51, 61], [12, 12, 14, 19, 26, 58, 60, 55], [14, 13, 16, 24, 40, 57, 69, 56], [14, 17, 22, 29, 51, 87, 80, 62], [18, 22, 37, 56, 68, 109, 103, 77], [24, 35, 55, 64, 81, 104, 113, 92], [49, 64, 78, 87, 103, 121, 120, 101], [72, 92, 95, 98, 112, 100, 103, 99]])
_CHROMA = np.array([[17, 18, 24, 47, 99, 99, 99, 99], [18, 21, 26, 66, 99, 99, 99, 99], [24, 26, 56, 99, 99, 99, 99, 99], [47, 66, 99, 99, 99, 99, 99, 99], *[[99] * 8] * 4])


def _dct_loss(rgb: np.ndarray, quality: float, halve: bool) -> np.ndarray:
    """The loss of a JPEG round trip: quantised 8 x 8 cosine transforms of Y, Cb and Cr.
    Entropy coding loses nothing and is left out."""
    q = min(100, max(1, quality))
    s = 5000 / q if q < 50 else 200 - 2 * q
    to = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])
    h, w = rgb.shape[:2]
    k = np.arange(8)
    basis = np.sqrt(np.where(k == 0, 1, 2) / 8)[:, None] * np.cos((2 * k[None] + 1) * k[:, None] * np.pi / 16)
    planes = rgb.astype(float) @ to.T
    out = np.empty_like(planes)
    for c in range(3):
        p = planes[..., c] - (128 if c == 0 else 0)
        small = halve and c > 0
        if small:
            p = np.pad(p, ((0, h % 2), (0, w % 2)), mode="edge")
            p = p.reshape(p.shape[0] // 2, 2, p.shape[1] // 2, 2).mean(axis=(1, 3))
        ph, pw = p.shape
        wide = np.pad(p, ((0, -ph % 8), (0, -pw % 8)), mode="edge")
        tiles = wide.reshape(wide.shape[0] // 8, 8, wide.shape[1] // 8, 8).swapaxes(1, 2)
        table = np.clip(np.floor(((_CHROMA if c else _LUMA) * s + 50) / 100), 1, 255)
        tiles = basis.T @ (np.round(basis @ tiles @ basis.T / table) * table) @ basis
        p = tiles.swapaxes(1, 2).reshape(wide.shape)[:ph, :pw]
        out[..., c] = (np.repeat(np.repeat(p, 2, 0), 2, 1)[:h, :w] if small else p) + (128 if c == 0 else 0)
    return _byte(out @ np.linalg.inv(to).T)


def jpeg(rgb, o, rng):
    q, chroma = _number(o.get("quality", 75), rng), o.get("chroma_subsampling", "random")
    if chroma not in ("random", "4:4:4", "4:2:0"):
        raise StageError(f"jpeg: chroma_subsampling {chroma!r} is unknown")
    return _dct_loss(rgb, q, rng.random() < 0.5 if chroma == "random" else chroma == "4:2:0")


def webp(rgb, o, rng):
    """No codec is at hand: the loss of a halved-chroma transform stands in for it."""
    return _dct_loss(rgb, _number(o.get("quality", 75), rng), True)


def _byte(x: np.ndarray) -> np.ndarray:
    whole = np.rint(x)
    return np.minimum(np.maximum(whole, 0, out=whole), 255, out=whole).astype(np.uint8)


def _number(spec, rng) -> float:
    """A number, [min, max], {min, max} or {choices}."""
    if isinstance(spec, dict) and "choices" in spec:
        w = np.array([max(0.0, float(c.get("weight", 1.0))) for c in spec["choices"]])
        w = w if w.sum() > 0 else np.ones(len(w))
        at = int(np.searchsorted(np.cumsum(w), rng.random() * w.sum(), "left"))
        return _number(spec["choices"][min(at, len(w) - 1)]["value"], rng)
    if isinstance(spec, dict):
        spec = [spec["min"], spec["max"]]
    if isinstance(spec, (list, tuple)):
        lo, hi = spec
        return int(rng.integers(lo, hi + 1)) if isinstance(lo, int) and isinstance(hi, int) else float(lo + (hi - lo) * rng.random())
    return spec


def rotate(rgb: np.ndarray, degrees: float, fill) -> tuple[np.ndarray, float, float]:
    """(image on a canvas that holds all of it, dx, dy of the centre), bilinear."""
    h, w = rgb.shape[:2]
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    nw, nh = math.ceil(abs(w * c) + abs(h * s) - 1e-9), math.ceil(abs(w * s) + abs(h * c) - 1e-9)
    x, y = np.arange(nw)[None, :] + 0.5 - nw / 2, np.arange(nh)[:, None] + 0.5 - nh / 2
    sx, sy = x * c - y * s + w / 2 - 0.5, x * s + y * c + h / 2 - 0.5
    wide = np.empty((h + 2, w + 2, 3))
    wide[1:-1, 1:-1] = rgb
    wide[[0, -1]], wide[:, [0, -1]] = fill, np.array(fill, float)
    sx, sy = np.minimum(np.maximum(sx + 1, 0), w + 0.999), np.minimum(np.maximum(sy + 1, 0), h + 0.999)
    ix, iy = sx.astype(int), sy.astype(int)
    fx, fy = (sx - ix)[..., None], (sy - iy)[..., None]
    # The edge of one pixel holds every right and lower neighbour; places in rows laid end to end.
    flat, at = wide.reshape(-1, 3), iy * (w + 2) + ix
    left, above = 1 - fx, 1 - fy
    pixels = lambda step: np.take(flat, at + step, axis=0)
    out = (pixels(0) * left + pixels(1) * fx) * above + (pixels(w + 2) * left + pixels(w + 3) * fx) * fy
    return _byte(out), (nw - w) / 2, (nh - h) / 2


def skew(sample: dict, o: dict, rng) -> dict:
    """Turns the image and every collection of boxes with it."""
    angle = _number(o.get("angle_deg", 0.0), rng)
    if angle == 0:
        return sample
    fill = o.get("fill", "background")
    named = {"background": sample["background"], "white": (255,) * 3, "black": (0,) * 3, "transparent": (255,) * 3}
    colour = tuple(fill) if isinstance(fill, (list, tuple)) else named.get(fill)
    if colour is None:
        raise StageError(f"skew: fill {fill!r} is unknown")
    h, w = sample["image"].shape[:2]
    image, dx, dy = rotate(sample["image"], angle, colour)
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))

    def turn(b):
        xs = [(x - w / 2) * c + (y - h / 2) * s + w / 2 + dx for x in (b[0], b[2]) for y in (b[1], b[3])]
        ys = [(y - h / 2) * c - (x - w / 2) * s + h / 2 + dy for x in (b[0], b[2]) for y in (b[1], b[3])]
        return tuple(int(round(round(v, 9))) for v in (min(xs), min(ys), max(xs), max(ys)))

    out = {**sample, "image": image, "bbox": turn(sample["bbox"]), "glyphs": [(k, turn(b)) for k, b in sample["glyphs"]]}
    for name in ("words", "lines", "paragraphs"):
        out[name] = [(t, turn(b)) for t, b in sample[name]]
    return out


PIXEL_STAGES: dict[str, Callable] = {
    "blur": blur,
    "noise": noise,
    "brightness": brightness,
    "contrast": contrast,
    "gamma": gamma,
    "ink_bleed": _spread(np.minimum),
    "ink_thin": _spread(np.maximum),
    "paper_texture": paper_texture,
    "foxing": foxing,
    "jpeg": jpeg,
    "webp": webp,
    "grayscale": grayscale,
}
GEOMETRY_STAGES: dict[str, Callable] = {"skew": skew}


def register_stage(kind: str, stage: Callable, geometry: bool = False) -> None:
    """Adds a stage: ``(image, options, rng) -> image`` or, for ``geometry``,
    ``(sample, options, rng) -> sample``.  A kind is registered once."""
    if not kind or kind in PIXEL_STAGES or kind in GEOMETRY_STAGES:
        raise StageError(f"degradation {kind!r} is registered already or has no name")
    (GEOMETRY_STAGES if geometry else PIXEL_STAGES)[kind] = stage


def registered(kinds: list[str]) -> tuple[dict[str, Callable], dict[str, Callable]]:
    """The stages of these kinds, for the workers: (pixel stages, geometry stages)."""
    return tuple({k: held[k] for k in kinds if k in held} for held in (PIXEL_STAGES, GEOMETRY_STAGES))


def degrade(sample: dict, stages: list[dict], rng, known: tuple[dict, dict] | None = None) -> dict:
    """The stages in order; each takes one draw, and is skipped when that reaches its
    probability.  ``known``: the registered stages, where a worker got them from the driver."""
    pixel, geometry = known or (PIXEL_STAGES, GEOMETRY_STAGES)
    for stage in stages:
        options = {k: v for k, v in stage.items() if k not in ("kind", "probability", "name")}
        kind = stage["kind"]
        if kind not in pixel and kind not in geometry:
            raise StageError(f"degradation {kind!r} is unknown")
        if rng.random() >= stage.get("probability", 1.0):
            continue
        sample = geometry[kind](sample, options, rng) if kind in geometry else {**sample, "image": pixel[kind](sample["image"], options, rng)}
    return sample
