"""Helpers of the operators' DataFrames."""

import ctypes

import psutil
import pytest

from riskloom.llm.frames import tidied


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="GNU C library only")
def test_a_task_gives_back_what_it_has_freed():
    def rss():
        return psutil.Process().memory_info().rss >> 20
    pinned = []

    def run(batches):
        held = [bytes(4000) for _ in range(50_000)]
        pinned.append(bytes(4000))  # above them, so the heap can't shrink from its end
        peaks.append(rss())
        del held
        yield from batches
    peaks = []
    assert list(tidied(run)(iter("ab"))) == ["a", "b"]
    assert peaks[0] - rss() > 100
