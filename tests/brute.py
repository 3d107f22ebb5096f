"""Plain-Python evaluation of every metric, row by row, straight from the
"""

from __future__ import annotations

import calendar
import json
import re
from collections import defaultdict
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal

from tarmac.functions.names import AIRPORT_NAME_PATTERN, CITY_NAME_PATTERN
from tarmac.schemas import PERIOD_COLUMNS

PERIODS = [(c, 6 * i, 6 * i + 6) for i, c in enumerate(PERIOD_COLUMNS.values())]
CLASSES = ["Economy", "Business", "Comfort"]


def clean(text, pattern):
    try:
        obj = json.loads(text) if text is not None else None
    except ValueError:
        obj = None
    joined = " | ".join(str(v) for v in obj.values() if v is not None) if isinstance(obj, dict) else ""
    m = re.match(pattern, joined)
    return m.group(1) if m else ""


def day(ts):
    return ts.strftime("%Y-%m-%d") if ts is not None else None


def epoch(ts):
    return None if ts is None else calendar.timegm(ts.timetuple())


def r2(x):
    if x is None:
        return None
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def percent(p, s):
    if p is None or s is None or s == 0:
        return None
    return r2(p / s * 100)


class Data:
    def __init__(self, rows):
        self.aircrafts = rows["aircrafts_data"]
        self.airports = [(a[0], clean(a[1], AIRPORT_NAME_PATTERN), clean(a[2], CITY_NAME_PATTERN)) for a in
                         rows["airports_data"]]
        self.bookings = rows["bookings"]
        self.departures = [dict(zip(["flight_id", "flight_no", "sched", "sched_arr", "dep", "arr", "status",
                                  "aircraft", "act_dep", "act_arr"], f)) for f in rows["departures"]]
        self.seats = rows["seats"]
        self.segments = rows["segments"]
        self.tickets = rows["tickets"]

    def names_of(self, code):
        found = [a[1] for a in self.airports if code is not None and a[0] == code]
        return found or [None]

    # -- shared row sets ------------------------------------------------
    def completed(self, require_id, require_arrived):
        for f in self.departures:
            if f["act_dep"] is None or f["act_arr"] is None:
                continue
            if require_id and f["flight_id"] is None:
                continue
            if require_arrived and f["status"] != "Arrived":
                continue
            for name in self.names_of(f["dep"]):
                yield (day(f["sched"]), name), f

    def segs_of(self, fid):
        return [s for s in self.segments if fid is not None and s[1] == fid]

    # -- metrics ----------------------------------------------------------
    def bookings_metric(self):
        out = defaultdict(int)
        for b in self.bookings:
            d = day(b[1])
            tickets = [t for t in self.tickets if b[0] is not None and t[1] == b[0]]
            if not tickets:
                out[(d, None)] += 1
            for t in tickets:
                segs = [s for s in self.segments if s[0] == t[0]]
                if not segs:
                    out[(d, None)] += 1
                for s in segs:
                    fl = [f for f in self.departures if s[1] is not None and f["flight_id"] == s[1]]
                    if not fl:
                        out[(d, None)] += 1
                    for f in fl:
                        for name in self.names_of(f["dep"]):
                            out[(d, name)] += 1
        return dict(out)

    def revenue(self):
        groups = defaultdict(list)
        for key, f in self.completed(True, True):
            amounts = [s[3] for s in self.segs_of(f["flight_id"]) if s[3] is not None]
            groups[key].append(sum(amounts) if amounts else None)
        out = {}
        for key, vals in groups.items():
            vals = [v for v in vals if v is not None]
            out[key] = int(sum(vals).to_integral_value(rounding=ROUND_DOWN)) if vals else None
        return out

    def airtime(self):
        groups = defaultdict(list)
        for key, f in self.completed(True, True):
            groups[key].append(epoch(f["act_arr"]) - epoch(f["act_dep"]))
        return {k: r2(sum(v) / 60) for k, v in groups.items()}

    def periods(self):
        out = {}
        for key, f in self.completed(True, True):
            row = out.setdefault(key, {p: 0 for p, _, _ in PERIODS})
            h = f["sched"].hour if f["sched"] is not None else None
            for p, lo, hi in PERIODS:
                if h is not None and lo <= h < hi:
                    row[p] += 1
        return out

    def delay_rows(self):
        """The standalone metric: one (date, name, average) a day and airport code."""
        groups = defaultdict(list)
        for f in self.departures:
            if f["act_dep"] is not None and f["act_arr"] is not None:
                own = groups[(day(f["sched"]), f["dep"])]
                if f["sched"] is not None:
                    own.append(epoch(f["act_dep"]) - epoch(f["sched"]))
        return [
            (d, name, r2(float(sum(v)) / len(v)) if v else None) for (d, code), v in groups.items() for name in self.names_of(code)
        ]

    def delay(self):
        groups = defaultdict(list)
        for key, f in self.completed(False, False):
            if f["sched"] is not None:
                groups[key].append(epoch(f["act_dep"]) - epoch(f["sched"]))
            else:
                groups.setdefault(key, [])
        return {k: (r2(float(sum(v)) / len(v)) if v else None) for k, v in groups.items()}

    def occupancy(self):
        seats = defaultdict(int)
        for s in self.seats:
            seats[s[0]] += 1
        groups = defaultdict(lambda: [[], []])
        for key, f in self.completed(True, False):
            n = len(self.segs_of(f["flight_id"]))
            groups[key][0].append(n if n else None)
            groups[key][1].append(seats.get(f["aircraft"]))
        out = {}
        for key, (p, s) in groups.items():
            p = [x for x in p if x is not None]
            s = [x for x in s if x is not None]
            v = percent(sum(p) if p else None, sum(s) if s else None)
            out[key] = 0.0 if v is None else v
        return out

    def fare_class(self):
        fleet = {a[0] for a in self.aircrafts}
        seat_c = defaultdict(int)
        for s in self.seats:
            if s[0] in fleet and s[2] in CLASSES:
                seat_c[(s[0], s[2])] += 1
        groups = defaultdict(lambda: {c: [0, 0] for c in CLASSES})
        for key, f in self.completed(True, False):
            segs = self.segs_of(f["flight_id"])
            for c in CLASSES:
                groups[key][c][0] += sum(1 for s in segs if s[2] == c)
                groups[key][c][1] += seat_c.get((f["aircraft"], c), 0)
        out = {}
        for key, per in groups.items():
            out[key] = {f"avg_occupancy_{c.lower()}": (percent(p, s) or 0.0) for c, (p, s) in per.items()}
        return out

    # -- spine and mart -------------------------------------------------
    def spine(self):
        days = {day(f["sched"]) for f in self.departures} | {day(b[1]) for b in self.bookings}
        names = {a[1] for a in self.airports}
        return [(d, n) for d in days for n in names]

    def mart(self):
        bk, rv, at, pr, dl, oc, fc = (self.bookings_metric(), self.revenue(), self.airtime(), self.periods(),
                                      self.delay(), self.occupancy(), self.fare_class())

        def get(m, key):
            return m.get(key) if key[0] is not None and key[1] is not None else None

        rows = []
        for key in self.spine():
            p = get(pr, key) or {}
            c = get(fc, key) or {}
            rows.append((
                key[0], key[1], get(bk, key) or 0, get(rv, key) or 0, get(at, key) or 0.0,
                *[p.get(c, 0) for c, _, _ in PERIODS],
                get(dl, key) or 0.0, get(oc, key) or 0.0,
                c.get("avg_occupancy_economy", 0.0), c.get("avg_occupancy_business", 0.0),
                c.get("avg_occupancy_comfort", 0.0),
            ))
        return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
