"""Parity oracle for W1-W8: a run as a fold of one pure step over its polls.

The step takes the run so far and one poll and gives the run after it, by the rules of the
blueprint: which poll is read, which of its rows count, which are new, what the counters become.
"""

from __future__ import annotations

import dataclasses
import functools


@dataclasses.dataclass(frozen=True)
class Run:
    seen: frozenset = frozenset()
    kept: tuple = ()
    dups: int = 0
    no_growth: int = 0
    repeats: int = 0
    ended: bool = False


def is_read(poll, r) -> bool:
    total = not r.require_total_results or (poll.get("total_results") or 0) > 0
    return r.status_policy == "none" or (poll["status"] == 200 and total)


def counted(poll, r) -> list:
    """Rows of a poll up to its first failed one (W1), without those passed over in silence."""
    rows = sorted(poll["articles"], key=lambda a: a["pos"])
    if not r.null_policy.startswith("truncate"):
        return rows
    failed = min((a["pos"] for a in rows if a["content"] is None), default=float("inf"))
    silent = r.null_policy == "truncate_skip_empty"
    return [a for a in rows if a["pos"] < failed and not (silent and not a.get("cleaned", a["content"]))]


def step(r, run: Run, poll) -> Run:
    full = r.stop_variant == "cap" and len(run.kept) >= r.cap
    if run.ended or full or not is_read(poll, r):
        skipped = not full and r.status_policy == "skip"
        return run if skipped else dataclasses.replace(run, ended=True)
    rows = counted(poll, r)
    able = [a for a in rows if a["content"] or r.null_policy not in ("skip_falsy", "as_dup")]
    first = {a["publishdate"]: a["pos"] for a in reversed(able)}
    new = sorted(pos for date, pos in first.items() if date not in run.seen)
    inpage = r.stop_variant == "inpage"
    flags = sum(not a["content"] and not (new and a["pos"] > new[0]) for a in rows) if inpage else 0
    no_growth = run.no_growth + (flags if inpage else not new)
    dups = run.dups + len(able if r.null_policy == "skip_falsy" else rows) - len(new)
    repeats = sum(a["pos"] > new[-1] for a in rows) if new else run.repeats + len(rows)
    if inpage and no_growth >= r.max_no_growth:
        new = []  # the flags that end the run come before its first new row
    ended = no_growth >= r.max_no_growth or dups > r.max_dups or (r.stop_variant == "trailing_repeat" and repeats == r.rep_stop)
    return Run(run.seen | set(first), run.kept + tuple((poll["poll_no"], pos) for pos in new), dups, no_growth, repeats, ended)


def simulate(polls, r) -> list:
    """Collected (poll_no, pos). ``polls``: dicts ``poll_no, status, total_results, articles``, an
    article being a dict ``pos, publishdate, content, cleaned``."""
    return list(functools.reduce(functools.partial(step, r), sorted(polls, key=lambda p: p["poll_no"]), Run()).kept)


def poll_stats(polls, r) -> list:
    """(poll_no, n_new, n_dup) of every poll up to the first that is not read, whatever the thresholds."""
    r = dataclasses.replace(r, max_dups=float("inf"), max_no_growth=float("inf"))
    out, run = [], Run()
    for poll in sorted(polls, key=lambda p: p["poll_no"]):
        after = step(r, run, poll)
        if after.ended:
            break
        out.append((poll["poll_no"], len(after.kept) - len(run.kept), after.dups - run.dups))
        run = after
    return out
