"""The rules of sessions, exits and dwell time, row by row."""

from __future__ import annotations

import random
from collections import defaultdict


def random_log(seed: int, rows: int, ticks: int) -> list[tuple]:
    """(v1, browser, ts, first_page) with ties, NULL browsers, NULL timestamps of
    pages, and one browser with half of all rows."""
    rng = random.Random(seed)
    log = []
    for v1 in range(rows):
        browser = rng.choice(["hot"] * 6 + ["b1", "b2", "b3", "b4", "b5", None])
        ts = 1_404_600_000_000 + rng.randrange(ticks) * rng.choice([1, 3_000_000])
        # b1 never enters
        entry = 1 if browser != "b1" and rng.random() < 0.15 else None
        if entry is None and rng.random() < 0.05:
            ts = None
        log.append((v1, browser, ts, entry))
    return log


def trace(log: list[tuple]) -> dict[int, tuple]:
    """v1 -> (first_page, session, exit_page, time)."""
    by_browser = defaultdict(list)
    result = {}
    for row in log:
        if row[1] is None:
            result[row[0]] = (None, 0, None, None)
        else:
            by_browser[row[1]].append(row)
    for rows in by_browser.values():
        entries = [r for r in rows if r[3] == 1]
        session = {}
        for v1, _, ts, _ in rows:
            if len(entries) == 1:
                session[v1] = 1
            elif ts is None:
                session[v1] = 0
            else:
                session[v1] = sum(e[2] is not None and e[2] <= ts for e in entries)
        visits = defaultdict(list)
        for v1, _, ts, _ in rows:
            if ts is not None:
                visits[session[v1]].append((ts, v1))
        following, last = {}, {}
        for number, pages in visits.items():
            pages.sort()
            last[number] = pages[-1][0]
            for (ts, v1), (next_ts, _) in zip(pages, pages[1:]):
                following[v1] = float(next_ts - ts)
        for v1, _, ts, first in rows:
            number = session[v1]
            leaves = 1 if ts is not None and ts == last[number] else None
            result[v1] = (first if number else None, number, leaves, following.get(v1))
    return result
