"""Random search over a space of parameters."""

from __future__ import annotations

import json
import logging
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from clickloom import constants as C

log = logging.getLogger(__name__)

SCHEMA = "trial int, score double, params string, error string"


def draw(space: dict[str, dict], rng: random.Random) -> dict[str, float | int]:
    """One value per parameter: ``{"type": "int"|"float", "bounds": [a, b], "log": bool}``."""
    chosen: dict[str, float | int] = {}
    for name, spec in space.items():
        low, high = spec["bounds"]
        if spec.get("type", "float") == "int":
            chosen[name] = rng.randint(low, high)
        elif spec.get("log", False):
            chosen[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            chosen[name] = rng.uniform(low, high)
    return chosen


Trial = tuple[int, float | None, dict, str | None]


def _run_trials(objective: Callable[[dict], float], drawn: list[tuple[int, dict]], threads: int) -> list[Trial]:
    """One entry per draw, in their order. A failed trial is recorded and skipped."""

    def run(number: int, params: dict) -> Trial:
        try:
            return number, float(objective(params)), params, None
        except Exception as error:  # noqa: BLE001 - one bad draw must not end the search
            log.warning("trial %s failed: %s", number, error)
            return number, None, params, str(error)

    if threads == 1:
        return [run(n, p) for n, p in drawn]
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda d: run(*d), drawn))


def _ranked(history: list[Trial], direction: str) -> list[Trial]:
    """Trials with a score, best first, earlier ones first among equal scores."""
    sign = 1 if direction == "maximize" else -1
    done = [h for h in history if h[1] is not None and not math.isnan(h[1])]
    return sorted(done, key=lambda h: (-sign * h[1], h[0]))


def random_search(
    objective: Callable[[dict], float],
    space: dict[str, dict],
    trials: int,
    direction: str = "maximize",
    seed: int = C.SEED,
    threads: int = 1,
    rungs: Sequence[dict] = ({},),
) -> tuple[dict | None, list[Trial]]:
    """Best parameters and the log of all trials. A failed trial is recorded and skipped.

    All draws are made first, so trials that run side by side in ``threads`` driver threads get the same
    parameters as one after the other. ``rungs`` are settings added to those drawn, from cheap to full, such as a growing
    number of iterations: after each one the better half of its trials, rounded up, goes on to the next. A trial's log
    entry is that of the last rung it reached; only trials of the last rung that scored can be the best.
    """
    if direction not in ("maximize", "minimize"):
        raise ValueError(f"unknown direction: {direction}")
    rng = random.Random(seed)
    left = [(number, draw(space, rng)) for number in range(trials)]
    history: dict[int, Trial] = {}
    for step, rung in enumerate(rungs):
        done = _run_trials(objective, [(n, {**p, **rung}) for n, p in left], threads)
        history |= {h[0]: h for h in done}
        ranked = _ranked(done, direction)
        if step < len(rungs) - 1:
            further = {h[0] for h in ranked[: (len(ranked) + 1) // 2]}
            left = [(n, p) for n, p in left if n in further]
    best = ranked[0][2] if ranked else None
    return best, [history[n] for n in sorted(history)]


def trials_table(spark: SparkSession, history: list) -> DataFrame:
    """The log of a search: one row per trial."""
    rows = [(n, s, json.dumps(p, sort_keys=True), e) for n, s, p, e in history]
    return spark.createDataFrame(rows, SCHEMA)
