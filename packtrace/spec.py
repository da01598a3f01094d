"""Column roles and thresholds shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

CANONICAL = {
    "device": "string",
    "seq": "bigint",
    "t_us": "bigint",
    "cycle": "bigint",
    "current": "double",
    "voltage": "double",
    "pack_voltage": "double",
    "cell_voltage": "double",
    "temperature": "double",
    "soc": "double",
    "capacity": "double",
}


@dataclass(frozen=True)
class ColumnSpec:
    """Which input column plays which role; ``None`` means the input has none.

    ``order`` is the arrival order of the rows, unique per device. ``time`` may be
    a timestamp, parseable text, or a number counted in ``time_unit``.
    """

    time: str
    order: str
    device: str | None = None
    cycle: str | None = None
    current: str | None = None
    voltage: str | None = None
    pack_voltage: str | None = None
    cell_voltage: str | None = None
    temperature: str | None = None
    soc: str | None = None
    capacity: str | None = None
    time_unit: str = "s"


# The defaults a caller of the original jobs gets.
@dataclass(frozen=True)
class IntegrityLimits:
    voltage_jump: float = 3.0
    current_jump: float = 25.0
    temp_jump: float = 8.0
    flatline_window: int = 20
    gap_multiplier: float = 3.0


@dataclass(frozen=True)
class FaultLimits:
    cc_slope: float = 0.02
    initial_share: float = 0.2


@dataclass(frozen=True)
class SohLimits:
    cc_slope: float = 0.015
    cv_slope: float = 0.003
    cv_quantile: float = 0.90
    min_voltage_step: float = 1e-6
    min_current_step: float = 1e-3


@dataclass(frozen=True)
class Skew:
    """How much of one group a single task may hold.

    A group expected to exceed ``rows_per_task`` rows is cut into ordered chunks of
    about that size. ``per_chunk`` sampled rows stand for one chunk, so the sampled
    share of the table is ``per_chunk / rows_per_task``. ``segment_us`` and ``segment_seq``
    name the width of the integrity checks' segments, in microseconds and arrival numbers;
    without them a sample tells whether segments are needed and how wide.
    """

    rows_per_task: int = 2_000_000
    per_chunk: int = 32
    seed: int = 17
    segment_us: int | None = None
    segment_seq: int | None = None

    @property
    def rate(self) -> float:
        return min(1.0, self.per_chunk / self.rows_per_task)
