"""The state of escalations takes little time for a key with many rows or slots, and gives what a loop over all rows gives."""

import random
import time

import pandas as pd
import pytest

from sieveline.streaming.escalation import _slots, rises

HOUR = 3_600_000_000


def looped(rows, highest, last, forget):
    out = []
    for at, rank in sorted(rows, key=lambda x: (x[0], -x[1])):
        if last is not None and at - last > forget:
            highest = 0
        if rank > highest:
            out.append((at, highest, rank))
            highest = rank
        last = at if last is None else max(last, at)
    return out, highest, last


@pytest.mark.parametrize("chunks,known", [(1, (0, None)), (50, (2, -HOUR)), (50, (3, -9 * HOUR))])
def test_many_slots(chunks, known):
    rng = random.Random(chunks)
    rows = [(rng.randrange(60_000) * HOUR + rng.randrange(3), rng.choice([-1, 0, 0, 0, 1, 2, 3])) for _ in range(40_000)]
    frames = [pd.DataFrame(rows[k::chunks], columns=["us", "rank"]).astype({"rank": "int32"}) for k in range(chunks)]
    began = time.process_time()
    got = rises(*_slots(iter(frames), HOUR), *known, 4 * HOUR)
    took = time.process_time() - began
    assert got == looped(rows, *known, 4 * HOUR) and len(got[0]) > 500
    assert took < 1.0  # frames of pandas for each slot took 0.3 ms or more a slot
