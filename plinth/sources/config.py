"""Settings: areas of interest, thresholds, storage paths; as an object or from a YAML file."""

from __future__ import annotations

import os
import posixpath
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Area:
    label: str
    bbox: tuple[float, float, float, float]
    geojson: str | None = None


@dataclass(frozen=True)
class Settings:
    """Paths stay strings, so any Hadoop file system works. sources: where each dataset's files lie, or which release listing names them."""

    root: str = "data"
    min_iou: float = 0.10
    high_iou: float = 0.80
    buffer_metres: float = 10.0
    cell: float = 0.001
    partition_degrees: float = 1.0
    sort_degrees: float = 0.01
    retries: int = 1
    retry_seconds: float = 1.0
    release: str | None = None
    areas: dict[str, Area] = field(default_factory=dict)
    sources: dict[str, dict] = field(default_factory=dict)
    attribution: dict = field(default_factory=dict)

    def path(self, layer: str, area: str, name: str) -> str:
        """layer (bronze, silver, gold, tiles), area and dataset below the root; a leading ~ is the home folder."""
        return posixpath.join(os.path.expanduser(self.root) if self.root.startswith("~") else self.root, layer, self.area(area), name)

    def area(self, name: str | None = None) -> str:
        """The named area, dashes as underscores; without a name the first."""
        if name is None:
            return next(iter(self.areas))
        key = name.replace("-", "_")
        if self.areas and key not in self.areas:
            raise KeyError(f"no such area: {name}; there are {', '.join(self.areas)}")
        return key


def load(path: str) -> Settings:
    """Settings of a YAML file. Paths of areas are relative to the file; what it leaves out has its default."""
    import yaml

    with open(path) as f:
        read = yaml.safe_load(f) or {}
    here = os.path.dirname(os.path.abspath(path))
    areas = {}
    for name, a in (read.get("aoi") or {}).items():
        shape = a.get("geojson")
        areas[name.replace("-", "_")] = Area(a.get("label", name), tuple(float(v) for v in a["bbox"]), shape if shape is None or "://" in shape else os.path.join(here, shape))
    known = {"root": (read.get("storage") or {}).get("root"), "release": (read.get("versions") or {}).get("release")}
    bridges, layout, run = read.get("bridges") or {}, read.get("layout") or {}, read.get("run") or {}
    known |= {k: bridges.get(k) for k in ("min_iou", "high_iou", "buffer_metres", "cell")}
    known |= {k: layout.get(k) for k in ("partition_degrees", "sort_degrees")} | {k: run.get(k) for k in ("retries", "retry_seconds")}
    return Settings(areas=areas, sources=read.get("sources") or {}, attribution=read.get("attribution") or {}, **{k: v for k, v in known.items() if v is not None})
