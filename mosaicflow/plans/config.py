"""Run settings: defaults, then a file's, then the caller's; a key that is not a setting is an error."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields


@dataclass
class RunConfig:
    tile_run: str = ""
    work: str = ""
    granules: str = "vsicurl"
    tiles: list[str] = field(default_factory=list)
    exclude_tiles: list[str] = field(default_factory=list)
    n_proc: int = 8
    res: float = 1 / 1200
    ps_res_m: float = 100.0
    cal_output: str = "gamma0"
    feather_km: float = 1.0
    retries: int = 2
    title: str = ""
    zoom: str = "0-8"
    tile_size: int = 512

    @classmethod
    def resolve(cls, file: dict | None = None, overrides: dict | None = None) -> RunConfig:
        known = {f.name for f in fields(cls)}
        merged: dict = {}
        for part in (file or {}, overrides or {}):
            unknown = sorted(set(part) - known)
            if unknown:
                raise ValueError(f"not settings: {', '.join(unknown)}")
            merged |= part
        return cls(**merged)

    def record(self) -> dict:
        return asdict(self)
