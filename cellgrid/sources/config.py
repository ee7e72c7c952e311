"""Settings of an experiment: a JSON file, overridden by named values, as one immutable object."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import PurePosixPath
from typing import Any


@dataclass(frozen=True)
class Config:
    analysis_root: str = ""
    data_root: str = ""
    segmentation_root: str = ""
    output_root: str = ""
    experiment: str = ""
    segmentation_name: str = ""
    mask_size: int = 2048
    omit_fovs: tuple[int, ...] = ()
    flip_barcodes: bool = True
    transpose_barcodes: bool = False
    minimum_cell_volume: float = 0.0
    maximum_cell_volume: float = float("inf")
    colors: tuple[str, ...] = ("750", "650", "561")
    rerun: bool = False
    other: dict[str, Any] = field(default_factory=dict)

    @property
    def scale(self) -> int:
        """Pixels of an image for each pixel of a mask."""
        return 2048 // self.mask_size

    def with_values(self, **values: Any) -> Config:
        """Given values replace those held; None leaves a value as it is, and unknown names go to `other`."""
        names = {f.name for f in fields(self)}
        given = {k: v for k, v in values.items() if v is not None}
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in names}
        return replace(self, **known, other=self.other | {k: v for k, v in given.items() if k not in names})

    def get(self, name: str, default: Any = None) -> Any:
        return getattr(self, name) if name in {f.name for f in fields(self)} else self.other.get(name, default)

    def has(self, name: str) -> bool:
        return self.get(name) not in (None, "")

    def path(self, root: str, segmented: bool = False) -> str:
        """root/experiment, and below it the segmentation where asked: `root` names a setting."""
        at = PurePosixPath(self.get(root)) / self.experiment
        return str(at / self.segmentation_name if segmented and self.segmentation_name else at)


def load(path: str | None = None, **values: Any) -> Config:
    held: dict[str, Any] = {}
    if path is not None:
        with open(path) as f:
            held = json.load(f)
    return Config().with_values(**held).with_values(**values)
