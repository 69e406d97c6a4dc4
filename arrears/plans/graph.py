"""Steps that depend on each other, run as soon as what they need is there."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Step:
    """What has to be there first, and the work: jobs of one session."""

    needs: Sequence[str]
    run: Callable[[], object]


class StepsFailed(RuntimeError):
    """Some steps failed; ``failed`` has their errors, ``left_out`` the steps that needed them."""

    def __init__(self, failed: Mapping[str, BaseException], left_out: Sequence[str]):
        self.failed, self.left_out = dict(failed), list(left_out)
        reasons = "; ".join(f"{name}: {str(error).splitlines()[0] if str(error) else type(error).__name__}" for name, error in failed.items())
        super().__init__(f"failed: {reasons}; left out: {', '.join(left_out) or 'none'}")


def run_steps(spark: SparkSession, steps: Mapping[str, Step], at_once: int = 8) -> list[str]:
    """Run all steps, independent ones at the same time; returns their names in order of completion.

    The jobs of a step go to a scheduler pool of its name, so that with a fair
    scheduler no branch starves another. A step that fails takes along the steps
    that need it and no others; when nothing is left to run, ``StepsFailed`` tells.
    """
    done: list[str] = []
    failed: dict[str, BaseException] = {}
    running: dict[Future, str] = {}
    waiting = dict(steps)

    def work(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        steps[name].run()

    with ThreadPoolExecutor(at_once) as pool:
        while True:
            ready = [n for n, s in waiting.items() if all(d in done for d in s.needs)]
            for name in ready:
                del waiting[name]
                running[pool.submit(inheritable_thread_target(spark)(work), name)] = name
            if not running:
                break
            for finished in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(finished)
                if finished.exception() is None:
                    done.append(name)
                else:
                    failed[name] = finished.exception()
    if failed:
        raise StepsFailed(failed, list(waiting)) from next(iter(failed.values()))
    if waiting:
        raise ValueError(f"steps need what no step makes: {sorted(waiting)}")
    return done
