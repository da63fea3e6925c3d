"""Thresholds of the rules, as one immutable value that plan builders take."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Settings:
    """Fixed values of the rules; distances in metres, angles in degrees, lengths in frames."""

    fps: int = 30
    # S1: jumps, blocks, spikes, gaps
    position_step: float = 0.15
    rotation_step: float = 45.0
    max_block: int = 15
    recovery: float = 0.15
    hampel_k: float = 3.0
    hampel_position: float = 0.10
    hampel_rotation: float = 30.0
    max_gap: int = 30
    # S2: both hands at the image border or outside
    edge_fraction: float = 0.05
    edge_frames: int = 60
    # S3: camera motion
    s3_gap: int = 6
    s3_translation: float = 0.075
    s3_rotation: float = 7.5
    skip_s3: bool = False
    # S4: hands stable to the camera's axis while it moves
    s4_gap: int = 30
    s4_spread: float = 0.03
    s4_translation: float = 0.20
    s4_rotation: float = 20.0
    s4_slack: float = 1e-5
    s4_starts: int = 30

    def __post_init__(self) -> None:
        for name in ("position_step", "rotation_step", "recovery", "s3_translation", "s4_translation", "s4_spread"):
            value = getattr(self, name)
            if not (math.isfinite(value) and value > 0):
                raise ValueError(f"{name} must be finite and positive")
        for name in ("s3_rotation", "s4_rotation"):
            if not 0 < getattr(self, name) < 180:
                raise ValueError(f"{name} must lie between 0 and 180")
        for name in ("fps", "max_block", "max_gap", "edge_frames", "s3_gap", "s4_gap", "s4_starts"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if not 0 <= self.edge_fraction < 0.5:
            raise ValueError("edge_fraction must lie between 0 and 0.5")

    def fingerprint(self) -> str:
        """Changes with every threshold; written beside results to guard reruns."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


#: Changes whenever the rules give other results, so that what an earlier version wrote is not taken up.
ALGORITHM = "3"

#: Names of bits of S1 codes, and of timeline reasons.
BITS = {1: "block_position_jump", 2: "block_rotation_jump", 4: "hampel_position_spike", 8: "hampel_rotation_spike", 16: "nonfinite_pose", 32: "invalid_rotation", 64: "delay_mismatch"}
REASONS = {0: "keep", 1: "s1_outlier", 2: "s2_hands_at_edge", 31: "s3_translation", 32: "s3_rotation", 33: "s3_both", 41: "s4_translation", 42: "s4_rotation", 43: "s4_both"}
