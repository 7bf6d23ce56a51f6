"""Typed configuration from INI text."""

from __future__ import annotations

import configparser
import dataclasses
import re
from dataclasses import dataclass, field
from pathlib import Path


def _list(text: str) -> list[str]:
    return [x.strip() for x in text.strip().strip("[]()").split(",") if x.strip()]


@dataclass(frozen=True)
class Config:
    """Values and metadata of one processing configuration; absent values have the defaults given here."""

    resolution: float = 0.00072000072
    chunk_read: int = 2048
    chunk_process: int = 512
    chunk_write: int = 2048
    bbox: tuple[float, float, float, float] = (-179.999, -59.999, 179.999, 81.099)
    bands: tuple[str, ...] = ("vv",)
    start_year: int = 2015
    end_year: int = 2024
    low_backscatter_threshold: float = 0.001
    min_monthly_acquisitions: float = 1
    max_allowed_days_gap_per_orbit: int = 30
    min_years_for_median_std: int = 3
    extend_search_window: int = 16
    min_consec_snow_days: int = 56
    version: str = ""
    metadata: dict[str, str] = field(default_factory=dict)

    @property
    def water_years(self) -> list[int]:
        return list(range(self.start_year, self.end_year + 1))

    @property
    def time_extent(self) -> tuple[str, str]:
        """Covers the water years of both hemispheres."""
        return f"{self.start_year - 1}-10-01", f"{self.end_year + 1}-03-31"

    def as_dict(self) -> dict:
        return dataclasses.asdict(self)

    @classmethod
    def parse(cls, text: str, name: str = "") -> Config:
        """From INI text. One spatial_chunk_dim of older files stands for all three chunk sizes; without METADATA the version comes from the file's name."""
        parser = configparser.ConfigParser(interpolation=None)
        parser.optionxform = str
        parser.read_string(text)
        metadata = dict(parser["METADATA"]) if parser.has_section("METADATA") else {}
        raw = {k.lower(): v for k, v in parser["VALUES"].items()} if parser.has_section("VALUES") else {}
        values: dict = {}
        if "spatial_chunk_dim" in raw:
            values |= dict.fromkeys(("chunk_read", "chunk_process", "chunk_write"), int(raw["spatial_chunk_dim"]))
        edges = [raw.get(f"bbox_{side}") for side in ("left", "bottom", "right", "top")]
        if all(edges):
            values["bbox"] = tuple(float(e) for e in edges)
        for f in dataclasses.fields(cls):
            if f.name in raw and f.name not in ("metadata", "version", "bbox"):
                convert = {"bands": lambda s: tuple(_list(s)), "resolution": float, "low_backscatter_threshold": float, "min_monthly_acquisitions": float}.get(f.name, int)
                values[f.name] = convert(raw[f.name])
        return cls(**values, metadata=metadata, version=metadata.get("version") or version_of(name))

    @classmethod
    def load(cls, path: str | Path) -> Config:
        return cls.parse(Path(path).read_text(), Path(path).name)


def version_of(name: str) -> str:
    """v9 of global_config_v9.txt; empty where the name has none."""
    m = re.search(r"global_config_(v[^./]+)", name)
    return m[1] if m else ""
