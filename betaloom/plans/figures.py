"""Figures as SVG text, drawn on the driver from tables of bounded size (see operators.density), and small PNG images."""

from __future__ import annotations

import math
import struct
import zlib
from xml.sax.saxutils import escape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.operators import density

COLOURS = {"grey": "#8a8a8a", "red": "#c0392b", "blue": "#2457a6"}
W, H, LEFT, TOP, RIGHT, BOTTOM = 720, 480, 70, 40, 20, 60


def ticks(lo: float, hi: float, n: int = 6) -> list[float]:
    """Round numbers between lo and hi, about n of them: steps of 1, 2 or 5 times a power of ten."""
    if not hi > lo:
        return [lo]
    raw = (hi - lo) / max(1, n)
    power = 10 ** math.floor(math.log10(raw))
    step = next(m * power for m in (1, 2, 5, 10) if m * power >= raw * 0.999999)
    return [round(k * step, 12) for k in range(math.ceil(lo / step - 1e-9), math.floor(hi / step + 1e-9) + 1)]


class Canvas:
    """A frame with axes; places are given in data units."""

    def __init__(self, title: str, x: tuple[float, float], y: tuple[float, float], x_label: str = "", y_label: str = "", *, x_ticks: list[tuple[float, str]] | None = None, y_ticks: list[tuple[float, str]] | None = None):
        self.x, self.y = (x if x[1] > x[0] else (x[0] - 0.5, x[0] + 0.5)), (y if y[1] > y[0] else (y[0] - 0.5, y[0] + 0.5))
        self.items = [f'<text x="{W / 2}" y="24" font-size="16" text-anchor="middle">{escape(title)}</text>']
        for v, label in x_ticks if x_ticks is not None else [(t, f"{t:g}") for t in ticks(*self.x)]:
            self.items.append(f'<path d="M{self.px(v):.1f} {H - BOTTOM}v5" stroke="#333"/><text x="{self.px(v):.1f}" y="{H - BOTTOM + 18}" font-size="11" text-anchor="middle">{escape(label)}</text>')
        for v, label in y_ticks if y_ticks is not None else [(t, f"{t:g}") for t in ticks(*self.y)]:
            self.items.append(f'<path d="M{LEFT} {self.py(v):.1f}h-5" stroke="#333"/><text x="{LEFT - 8}" y="{self.py(v) + 4:.1f}" font-size="11" text-anchor="end">{escape(label)}</text>')
        self.items.append(f'<rect x="{LEFT}" y="{TOP}" width="{W - LEFT - RIGHT}" height="{H - TOP - BOTTOM}" fill="none" stroke="#333"/>')
        self.items.append(f'<text x="{(W + LEFT) / 2}" y="{H - 14}" font-size="13" text-anchor="middle">{escape(x_label)}</text><text transform="translate(16 {H / 2}) rotate(-90)" font-size="13" text-anchor="middle">{escape(y_label)}</text>')

    def px(self, v: float) -> float:
        return LEFT + (v - self.x[0]) / (self.x[1] - self.x[0]) * (W - LEFT - RIGHT)

    def py(self, v: float) -> float:
        return H - BOTTOM - (v - self.y[0]) / (self.y[1] - self.y[0]) * (H - TOP - BOTTOM)

    def box(self, x0: float, y0: float, x1: float, y1: float, fill: str, opacity: float = 1.0) -> None:
        a, b, c, d = self.px(x0), self.py(y1), self.px(x1), self.py(y0)
        self.items.append(f'<rect x="{a:.2f}" y="{b:.2f}" width="{c - a:.2f}" height="{d - b:.2f}" fill="{fill}" fill-opacity="{opacity:.3f}"/>')

    def text(self, x: float, y: float, label: str) -> None:
        self.items.append(f'<text x="{self.px(x):.1f}" y="{self.py(y) - 4:.1f}" font-size="10" text-anchor="middle">{escape(label)}</text>')

    def svg(self) -> str:
        return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {W} {H}" font-family="sans-serif">\n' + "\n".join(self.items) + "\n</svg>\n"


def volcano(points: DataFrame, labels: DataFrame, title: str = "Volcano", nx: int = 120, ny: int = 80) -> str:
    """Points (feature, delta_mean, neg_log10_p, point_class) counted in nx by ny cells; labels (feature) by name."""
    x0, x1, y0, y1 = density.extent(points, "delta_mean", "neg_log10_p")
    rows = density.grid_counts(points, "delta_mean", "neg_log10_p", "point_class", nx=nx, ny=ny, bounds=(x0, x1, y0, y1)).collect()  # at most three for each cell
    c, most = Canvas(title, (x0, x1), (y0, y1), "difference of means", "-log10 p"), math.log1p(max((r.n for r in rows), default=1))
    wide, high = (x1 - x0) / nx, (y1 - y0) / ny
    for r in sorted(rows, key=lambda r: (["grey", "red", "blue"].index(r.kind), r.ix, r.iy)):
        c.box(x0 + r.ix * wide, y0 + r.iy * high, x0 + (r.ix + 1) * wide, y0 + (r.iy + 1) * high, COLOURS[r.kind], 0.25 + 0.75 * math.log1p(r.n) / most)
    for r in points.join(F.broadcast(labels.select("feature")), "feature", "left_semi").limit(50).collect():
        c.text(r.delta_mean, r.neg_log10_p, r.feature)
    return c.svg()


def violins(dense: DataFrame, title: str = "Hypermethylation by group") -> str:
    """Rows of violin_density: a mirrored outline per group with its quartiles."""
    groups: dict[str, list] = {}
    for r in dense.orderBy("group", "at").collect():  # points times groups
        groups.setdefault(str(r.group), []).append(r)
    every = [r for g in groups.values() for r in g]
    most = max((r.density or 0.0 for r in every), default=1.0) or 1.0
    c = Canvas(title, (-0.5, max(len(groups), 1) - 0.5), (min((r.x for r in every), default=0), max((r.x for r in every), default=1)), "", "score", x_ticks=[(i, g) for i, g in enumerate(groups)])
    for i, rows in enumerate(groups.values()):
        side = [(0.4 * (r.density or 0.0) / most, r.x) for r in rows]
        path = [(i + d, x) for d, x in side] + [(i - d, x) for d, x in reversed(side)]
        c.items.append('<path d="M' + "L".join(f"{c.px(a):.1f} {c.py(b):.1f}" for a, b in path) + 'Z" fill="#9bb7d4" stroke="#2457a6"/>')
        c.box(i - 0.03, rows[0].q1, i + 0.03, rows[0].q3, "#222")
        c.items.append(f'<circle cx="{c.px(i):.1f}" cy="{c.py(rows[0].median):.1f}" r="3" fill="#fff" stroke="#222"/>')
    return c.svg()


def dots(best: DataFrame, title: str = "Enrichment") -> str:
    """Rows of dot_plot: a line per set, size by overlap, colour by odds ratio."""
    rows = best.orderBy(F.desc_nulls_last("neg_log10_q"), "pathway").limit(50).collect()
    odds = [r.odds_ratio for r in rows if r.odds_ratio is not None and math.isfinite(r.odds_ratio)]
    c = Canvas(title, (0, max((r.neg_log10_q or 0.0 for r in rows), default=1.0) or 1.0), (-0.5, max(len(rows), 1) - 0.5), "-log10 q", "", y_ticks=[(len(rows) - 1 - i, r.display_name[:24]) for i, r in enumerate(rows)])
    for i, r in enumerate(rows):
        share = 1.0 if r.odds_ratio is None or not math.isfinite(r.odds_ratio) or not odds else (r.odds_ratio - min(odds)) / ((max(odds) - min(odds)) or 1.0)
        size = 2 + 8 * math.sqrt(r.n_overlap / max(max(x.n_overlap for x in rows), 1))
        c.items.append(f'<circle cx="{c.px(r.neg_log10_q or 0.0):.1f}" cy="{c.py(len(rows) - 1 - i):.1f}" r="{size:.1f}" fill="rgb({int(60 + 180 * share)},60,{int(240 - 180 * share)})"/>')
    return c.svg()


def _warm(z: float) -> tuple[int, int, int]:
    """Blue for -3, white for 0, red for 3."""
    t = max(-1.0, min(1.0, z / 3))
    return (int(255 * (1 + min(t, 0))), int(255 * (1 - abs(t))), int(255 * (1 - max(t, 0))))


def _heat_table(bins: DataFrame) -> tuple[list[str], int, dict[tuple[str, int], float]]:
    rows = bins.select("feature", "column", "value").collect()  # features times columns
    return sorted({r.feature for r in rows}), 1 + max((r.column for r in rows), default=0), {(r.feature, r.column): r.value for r in rows}


def heat(bins: DataFrame, title: str = "Most variable genes") -> str:
    """Rows of heatmap_bins: a line per gene, a column per bin of samples."""
    genes, n, value = _heat_table(bins)
    c = Canvas(title, (0, n), (0, max(len(genes), 1)), "samples by group", "", x_ticks=[], y_ticks=[(len(genes) - i - 0.5, g) for i, g in enumerate(genes)])
    for (g, k), z in sorted(value.items()):
        y = len(genes) - 1 - genes.index(g)
        c.box(k, y, k + 1, y + 1, "#%02x%02x%02x" % _warm(z))
    return c.svg()


def png(pixels: np.ndarray) -> bytes:
    """An image of height by width by 3 bytes."""
    h, w, _ = pixels.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), pixels.astype(np.uint8).reshape(h, -1)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 9)) + chunk(b"IEND", b"")


def volcano_png(points: DataFrame, nx: int = 160, ny: int = 100, scale: int = 4) -> bytes:
    """The volcano's cells as an image, darker for more points."""
    rows = density.grid_counts(points, "delta_mean", "neg_log10_p", "point_class", nx=nx, ny=ny).collect()
    image, most = np.full((ny, nx, 3), 255.0), math.log1p(max((r.n for r in rows), default=1))
    for r in sorted(rows, key=lambda r: ["grey", "red", "blue"].index(r.kind)):
        colour = np.array([int(COLOURS[r.kind][i : i + 2], 16) for i in (1, 3, 5)])
        image[ny - 1 - r.iy, r.ix] = 255 + (colour - 255) * (0.3 + 0.7 * math.log1p(r.n) / most)
    return png(image.repeat(scale, axis=0).repeat(scale, axis=1))


def heat_png(bins: DataFrame, scale: int = 6) -> bytes:
    genes, n, value = _heat_table(bins)
    image = np.full((max(len(genes), 1), n, 3), 255)
    for (g, k), z in value.items():
        image[genes.index(g), k] = _warm(z)
    return png(image.repeat(scale * 2, axis=0).repeat(scale, axis=1))
