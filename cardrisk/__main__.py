"""``python -m cardrisk <job> --name value ...``; also a spark-submit entry point."""

from __future__ import annotations

import inspect
import sys

from cardrisk.plans import jobs
from cardrisk.session import build_session

JOBS = {
    name: job
    for name, job in vars(jobs).items()
    if inspect.isfunction(job) and job.__module__ == jobs.__name__ and not name.startswith("_")
}


def parse(job, words: list[str]) -> dict:
    """``--name value`` pairs, converted by the type of the parameter's default."""
    parameters = inspect.signature(job).parameters
    given = {}
    for name, value in zip(words[::2], words[1::2]):
        key = name.removeprefix("--").replace("-", "_")
        if key not in parameters:
            raise SystemExit(f"{job.__name__} has no option {name}")
        default = parameters[key].default
        if isinstance(default, tuple):
            given[key] = [part for part in value.split(",") if part]
        elif isinstance(default, (int, float)):
            given[key] = type(default)(value)
        else:
            given[key] = value
    return given


def main(words: list[str]) -> None:
    if not words or words[0] not in JOBS:
        lines = [f"  {name}{inspect.signature(job)}" for name, job in JOBS.items()]
        raise SystemExit("jobs:\n" + "\n".join(lines))
    job = JOBS[words[0]]
    given = parse(job, words[1:])
    result = job(build_session(f"cardrisk-{words[0]}"), **given)
    if result is not None:
        result.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
