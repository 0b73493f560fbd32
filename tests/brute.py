"""Direct statements of the checks over lists of rows, for small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date

BEYOND = date.max


def by_key(rows, n_keys=1):
    groups = defaultdict(list)
    for r in rows:
        groups[r[:n_keys]].append(r[n_keys:])
    return groups


def overlaps(rows, open_end=False):
    """Rows are (key, start, end, flag)."""
    out = Counter()
    for key, versions in by_key(rows).items():
        if None in key:
            continue
        for i, (s1, e1, _) in enumerate(versions):
            for j, (s2, e2, _) in enumerate(versions):
                a = BEYOND if e1 is None and open_end else e1
                b = BEYOND if e2 is None and open_end else e2
                if i == j or None in (s1, s2, a, b):
                    continue
                if s1 < b and a > s2 and s1 != s2:
                    out[(*key, s1, e1, s2, e2)] += 1
    return out


def _nulls_first(value):
    return (value is not None, value if value is not None else 0)


def broken_chain(rows):
    out = Counter()
    for key, versions in by_key(rows).items():
        ordered = sorted(versions, key=lambda v: tuple(_nulls_first(x) for x in v))
        for (start, end, flag), following in zip(ordered, ordered[1:]):
            after = following[0]
            if flag is False and after is not None and end is not None and end != after:
                out[(*key, start, end, after)] += 1
    return out


def profile(rows):
    groups = by_key(rows)
    current = {k: sum(v[2] is True for v in vs) for k, vs in groups.items()}
    return {
        "duplicate_current": sum(c > 1 for c in current.values()),
        "orphan_keys": sum(c == 0 for c in current.values()),
        "null_start": sum(r[1] is None for r in rows),
        "null_end_on_closed": sum(r[3] is False and r[2] is None for r in rows),
        "start_after_end": sum(None not in r[1:3] and r[1] > r[2] for r in rows),
        "chain_continuity": sum(broken_chain(rows).values()),
    }
