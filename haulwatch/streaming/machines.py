"""Keyed state machines: one position at a time, for streams.

``step`` changes the state of a vehicle in place and returns the rows it emits. A state is a
plain dict that survives a round trip through JSON. ``idle`` says after how many seconds without a position the
state makes no difference to what follows (null: it always may). The batch operators of the same names compute the
same rows without walking position by position.
"""

from __future__ import annotations

import json
import math
import sys
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle

# Executors get the functions of this module themselves, not a reference to an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR = 3600
DAY = 86400


def metres(lng1: float, lat1: float, lng2: float, lat2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h)))


def _known(value: Any) -> bool:
    return value is not None and value == value


@dataclass(frozen=True)
class TripMachine:
    """Stays and trips; see :func:`haulwatch.operators.movement.trips`."""

    strict: bool = False
    gap: int = 360
    columns: tuple[str, ...] = ("site_id", "site_flag")
    output: str = (
        "from_site_id long, from_site_flag int, from_site_inter_sec long, from_site_work_sec long, "
        "from_site_leave_sec long, to_site_id long, to_site_flag int, to_site_inter_sec long"
    )

    def idle(self, state: dict) -> int | None:
        return 0 if state.get("stay") is None else None

    def step(self, state: dict, row: Any) -> list[tuple]:
        site = int(row.site_id) if _known(row.site_id) else None
        stay, t = state.get("stay"), int(row.t_sec)
        if stay is None:
            if site is not None:
                state["stay"] = {"site": site, "flag": int(row.site_flag), "t": t, "work": None, "leave": None}
            return []
        if site is None:
            if self.strict:
                state["stay"] = {"site": None, "flag": None, "t": t, "work": None, "leave": None}
            elif stay["leave"] is None:
                stay["leave"] = t
            return []
        due, same = t - stay["t"] >= self.gap, site == stay["site"]
        if same and not due:
            stay["work"] = t
        if due and not same:
            state["stay"] = None
            return [(stay["site"], stay["flag"], stay["t"], stay["work"], stay["leave"], site, int(row.site_flag), t)]
        return []


def keep_alarm(state: dict, code: str, start: int, daily: tuple[str, ...] = ("0119",)) -> bool:
    """Thinning: whether an alarm of the code that starts now is kept."""
    last = state.setdefault("kept", {}).get(code)
    if last is not None:
        if code in daily and start // DAY == last // DAY:
            return False
        if code not in daily and (start - last) // HOUR < 2:
            return False
    state["kept"][code] = start
    return True


ALARM_OUTPUT = (
    "illegal_type_code string, start_sec long, start_event_id long, alarm_start_lng double, "
    "alarm_start_lat double, end_sec long, alarm_end_lng double, alarm_end_lat double"
)
FENCE_OUTPUT = ALARM_OUTPUT.replace(
    ", end_sec", ", fence_flag int, fence_id long, fence_name string, fence_area_id string, end_sec"
)


@dataclass(frozen=True)
class EpisodeMachine:
    """Alarms that open at an offending position and close at the next one that does not offend.

    ``offends`` names a boolean column (null: the position says nothing); ``codes`` names a
    column with the list of broken codes instead, or, if ``details`` names some, of JSON records with the code
    and these. ``jump_m`` asks for a distance between both."""

    code: str | None = None
    offends: str | None = None
    codes: str | None = None
    jump_m: float | None = None
    details: tuple[str, ...] = ()
    minutes: int = 3
    output: str = ALARM_OUTPUT

    @property
    def columns(self) -> tuple[str, ...]:
        return ("lng", "lat", self.offends or self.codes)

    def idle(self, state: dict) -> int | None:
        if state.get("open"):
            return None
        return DAY if state.get("kept") else 0

    def step(self, state: dict, row: Any) -> list[tuple]:
        if self.codes:
            broken = list(getattr(row, self.codes))
            if self.details:
                broken = [json.loads(text) for text in broken]
        else:
            flag = getattr(row, self.offends)
            if not _known(flag):
                return []
            broken = [self.code] if flag else []
        here = (int(row.t_sec), int(row.event_id), float(row.lng), float(row.lat))
        opened = state.setdefault("open", {})
        for found in broken:
            code = found["illegal_type_code"] if self.details else found
            opened.setdefault(code, (*here, *[found.get(name) for name in self.details]))
        if broken:
            return []
        out = []
        for code, start in sorted(opened.items()):
            long_enough = (here[0] - start[0]) // 60 > self.minutes
            moved = self.jump_m is None or metres(here[2], here[3], start[2], start[3]) > self.jump_m
            if long_enough and moved and keep_alarm(state, code, start[0]):
                out.append((code, *start, here[0], here[2], here[3]))
        opened.clear()
        return out


@dataclass(frozen=True)
class DailyAlarmMachine:
    """The first offending position of each calendar day."""

    code: str = "0111"
    offends: str = "offends"
    output: str = (
        "illegal_type_code string, start_sec long, start_event_id long, alarm_start_lng double, alarm_start_lat double"
    )

    @property
    def columns(self) -> tuple[str, ...]:
        return ("lng", "lat", self.offends)

    def idle(self, state: dict) -> int | None:
        return DAY

    def step(self, state: dict, row: Any) -> list[tuple]:
        if not getattr(row, self.offends) or not keep_alarm(state, self.code, int(row.t_sec), (self.code,)):
            return []
        return [(self.code, int(row.t_sec), int(row.event_id), float(row.lng), float(row.lat))]


@dataclass(frozen=True)
class PointAlarmMachine:
    """Alarms of single positions, thinned. All positions offend; ``site_id`` says where."""

    code: str
    columns: tuple[str, ...] = ("lng", "lat", "site_id")
    output: str = (
        "illegal_type_code string, start_sec long, start_event_id long, alarm_start_lng double, alarm_start_lat double, "
        "site_id long"
    )

    def idle(self, state: dict) -> int | None:
        return DAY

    def step(self, state: dict, row: Any) -> list[tuple]:
        if not keep_alarm(state, self.code, int(row.t_sec)):
            return []
        return [(self.code, int(row.t_sec), int(row.event_id), float(row.lng), float(row.lat), int(row.site_id))]


@dataclass(frozen=True)
class OnlineMachine:
    """Seconds online today, one row per position."""

    columns: tuple[str, ...] = ("speed", "lng", "lat")
    output: str = (
        "t_sec long, event_id long, lng double, lat double, speed double, online_time long, "
        "vehicle_status int, online_status int"
    )

    def idle(self, state: dict) -> int | None:
        return DAY

    def step(self, state: dict, row: Any) -> list[tuple]:
        t, shown = int(row.t_sec), 0
        if "t" not in state:
            state.update(t=t, total=0)
        elif t > state["t"]:
            shown = state["total"] + t - state["t"]
            if shown > t % DAY:
                shown = 0
            state.update(t=t, total=shown)
        moving = 1 if row.speed > 0 else 0
        return [(t, int(row.event_id), float(row.lng), float(row.lat), float(row.speed), shown, 0, moving)]


@dataclass(frozen=True)
class StopMachine:
    """Stops that were seen through to the first moving position."""

    gap: int = 180
    columns: tuple[str, ...] = ("speed", "lng", "lat")
    output: str = (
        "stop_sec long, stop_lng double, stop_lat double, start_sec long, start_lng double, start_lat double"
    )

    def idle(self, state: dict) -> int | None:
        return self.gap if state.get("stop") is not None else 0

    def step(self, state: dict, row: Any) -> list[tuple]:
        stop, t = state.get("stop"), int(row.t_sec)
        if row.speed > 0:
            state["stop"] = None
            if stop is not None and t - stop["seen"] < self.gap:
                return [(*stop["at"], t, float(row.lng), float(row.lat))]
        elif row.speed == 0:
            if stop is None or t - stop["seen"] > self.gap:
                state["stop"] = {"at": [t, float(row.lng), float(row.lat)], "seen": t}
            else:
                stop["seen"] = t
        return []


@dataclass(frozen=True)
class DwellMachine:
    """Visits of sites. ``near`` names the column with the ids of the sites the position is in.
    Holds the sites with an unfinished visit only."""

    seconds: int = 180
    near: str = "near"
    output: str = "site_id long, enter_sec long, exit_sec long"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.near,)

    def idle(self, state: dict) -> int | None:
        return None if state.get("visits") else 0

    def step(self, state: dict, row: Any) -> list[tuple]:
        visits, t, out = state.setdefault("visits", {}), int(row.t_sec), []
        inside = {str(int(s)) for s in getattr(row, self.near)}
        for site in sorted(inside):
            visit = visits.setdefault(site, {"enter": t, "exit": None, "sure": False})
            visit["sure"] = visit["sure"] or t - visit["enter"] > self.seconds
            visit["exit"] = None
        for site in [s for s in visits if s not in inside and visits[s]["sure"]]:
            visit = visits[site]
            if visit["exit"] is None:
                visit["exit"] = t
            elif t - visit["exit"] > self.seconds:
                out.append((int(site), visit["enter"], visit["exit"]))
                del visits[site]
        return out


