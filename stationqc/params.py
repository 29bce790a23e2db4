"""Parameter sets of the original workflow as frozen dataclasses (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Seasonal limits (min, max) in degrees Celsius used by the batch run.
BATCH_SEASON_LIMITS = {"DJF": (-30.0, 20.0), "MAM": (-10.0, 30.0), "JJA": (0.0, 40.0), "SON": (-10.0, 30.0)}
# The sequential run differs only in the summer maximum.
SEQUENTIAL_SEASON_LIMITS = {"DJF": (-30.0, 20.0), "MAM": (-10.0, 30.0), "JJA": (0.0, 45.0), "SON": (-10.0, 30.0)}


@dataclass(frozen=True)
class BuddyParams:
    radius: float = 5000.0          # metres, planar (projected) distance, inclusive
    num_min: int = 3
    threshold: float = 3.0
    max_elev_diff: float = -1.0     # <= 0 disables the altitude rule
    elev_gradient: float = 0.0
    min_std: float = 0.1


@dataclass(frozen=True)
class SctParams:
    """Greedy spatial (and spatio-temporal) consistency test.

    Radii are in the units of the coordinates (degrees of lon/lat), as in the
    original; ``metric='m'`` switches to projected metres.
    """
    inner_radius: float = 2000.0
    outer_radius: float = 8000.0
    num_min: int = 10
    num_max: int = 10
    pos_threshold: float = 0.5
    neg_threshold: float = 0.5
    # spatio-temporal variant only
    min_elev_diff: float = 20.0
    max_elev_diff: float = 200.0
    vertical_scale: float = 200.0
    temporal_threshold: float = 3.0
    eps: float = 0.1
    metric: str = "deg"


@dataclass(frozen=True)
class LongTermParams:
    window_hours: int = 720         # rolling window, centred, both ends inclusive
    seasonal_window_hours: float = 360.0
    z_threshold: float = 3.0
    min_samples: int = 720


# Shipped parameter sets.
BATCH_BUDDY = BuddyParams(radius=5000.0, num_min=3, threshold=3.0, max_elev_diff=100.0, elev_gradient=-0.0065)
BATCH_SCT = SctParams(inner_radius=2000.0, outer_radius=8000.0, num_min=10, num_max=10,
                      pos_threshold=0.5, neg_threshold=0.5)
SEQUENTIAL_BUDDY = BuddyParams(radius=5000.0, num_min=3, threshold=3.0, max_elev_diff=400.0, elev_gradient=-0.0065)
SEQUENTIAL_SCT = SctParams(inner_radius=2000.0, outer_radius=5000.0, num_min=10, num_max=10,
                           pos_threshold=0.5, neg_threshold=0.5, min_elev_diff=20.0, max_elev_diff=200.0,
                           vertical_scale=200.0, temporal_threshold=3.0, eps=0.1)
OVERLAY = LongTermParams(window_hours=720, seasonal_window_hours=360.0, z_threshold=3.0, min_samples=720)
MIN_COMPLETENESS = 0.8


# Parameters of the general (order-dependent) greedy case used by the fixtures.
GREEDY = SctParams(inner_radius=0.015, outer_radius=0.04, num_min=3, num_max=5, pos_threshold=1.0,
                   neg_threshold=1.0)
GREEDY_ST = replace(GREEDY, min_elev_diff=20.0, max_elev_diff=400.0, vertical_scale=-0.0065,
                    temporal_threshold=3.0, eps=0.1)
