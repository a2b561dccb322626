"""Grid and legend settings. All that results depend on is here, and goes into `params_hash`."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass

# The projected half-width of the world square and the published grid parameters.
MERC = 20037508.342789244
WORLD = 2 * MERC
CELL_DEGREES = 3

# The channel legend, in the order that decides ties (no-data first).
# idx, source codes, layer, kind, max_zoom, colour
LEGEND: tuple[tuple[int, tuple[int, ...], str | None, str | None, int, str | None], ...] = (
    (0, (0,), None, None, -1, None),
    (1, (10,), "land", "forest", 6, "#66AA44"),
    (2, (40,), "land", "farmland", 9, "#F0E7D1"),
    (3, (50,), "land", "residential", 9, "#EAE6E1"),
    (4, (60,), "land", "bare_rock", 9, "#D9D5CE"),
    (5, (100,), "land", "heath", 9, "#CFD3B0"),
    (6, (20,), "land", "scrub", 10, "#E0E4E5"),
    (7, (30,), "land", "grassland", 10, "#D8E8C8"),
    (8, (90,), "land", "marsh", 10, "#D3E6DB"),
    (9, (95,), "land", "swamp", 10, "#C6DCC6"),
    (10, (70,), "water_polygons", "glacier", 3, "#FFFFFF"),
    (11, (80,), "water_polygons", "water", 3, "#B3D9E6"),
)
LAYERS = ("land", "water_polygons")


@dataclass(frozen=True)
class Grid:
    """A tiled world raster. The defaults are the published ones; tests and queries use smaller grids of the same shape."""

    max_level: int = 10
    tile_px: int = 1024
    block_tiles: int = 8
    blur_radius: int = 3

    @property
    def sieve_px(self) -> int:
        """Regions with fewer pixels are absorbed: the area of a disc of the blur radius."""
        return round(math.pi * self.blur_radius**2)

    @property
    def margin_px(self) -> int:
        """Halo that blur (three radii) and sieve may reach across a block's edge."""
        return math.ceil(3 * self.blur_radius + 3 * math.sqrt(self.sieve_px))

    @property
    def block_px(self) -> int:
        return self.tile_px * self.block_tiles

    def size_px(self, z: int) -> int:
        """Pixels along an axis of level z."""
        return self.tile_px << z

    def blocks(self, z: int) -> int:
        return -(-(1 << z) // self.block_tiles)

    def kernel(self) -> list[int]:
        """Integer weights of the blur for offsets 0, 1, 2 ... 3 radii: round(64 exp(-k^2 / 2 r^2))."""
        return [round(64 * math.exp(-(k * k) / (2 * self.blur_radius**2))) for k in range(3 * self.blur_radius + 1)]

    def metres_per_px(self, z: int) -> float:
        return WORLD / (1 << z) / self.tile_px

    def tolerance(self, z: int) -> float:
        """Simplification tolerance in metres: a pixel of a 256-pixel tile."""
        return WORLD / (256 * 2**z)

    def params_hash(self) -> str:
        """Names results by everything that shapes them, so a changed parameter never meets stale results."""
        return hashlib.sha256(json.dumps([asdict(self), LEGEND]).encode()).hexdigest()[:12]


#: The grid of the queries over the driver's tables: a 64 x 64 raster at level 2, in 2 x 2 blocks of 32 pixels.
FIXTURE = Grid(max_level=2, tile_px=16, block_tiles=2, blur_radius=3)
