"""Independent steps of a load, run side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def together(*steps: Callable[[], object]) -> list:
    """Run steps at once, so the last tasks of one do not idle the cluster; fail if one fails."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [running.result() for running in [pool.submit(step) for step in steps]]
