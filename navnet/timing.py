"""How long a step took, in the log."""

from __future__ import annotations

import functools
import logging
import time
from collections.abc import Callable

log = logging.getLogger(__name__)


def timer(fn: Callable) -> Callable:
    """fn, whose every call is logged with its seconds, also where it fails (the error goes on)."""

    @functools.wraps(fn)
    def run(*args, **kwargs):
        began, failed = time.perf_counter(), True
        try:
            out = fn(*args, **kwargs)
            failed = False
            return out
        finally:
            log.log(logging.ERROR if failed else logging.INFO, "%s %s %.4f seconds", fn.__name__, "failed after" if failed else "took", time.perf_counter() - began)

    return run
