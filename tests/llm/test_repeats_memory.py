"""Memory of the Python helpers of op8_repeats, and their spans against a plain loop."""

import random
import tracemalloc

import pyarrow as pa

from keepline.llm import repeats

RANGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def plain(ranges, length):
    out = []
    for a, b in sorted((r["start"], r["stop"] - 1 + length) for r in ranges or []):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


def test_spans_are_those_of_a_plain_loop(spark):
    rng = random.Random(8)
    lists = [None, [], [{"start": 0, "stop": 1}]]
    for _ in range(300):
        starts = [rng.randrange(400) for _ in range(rng.randrange(9))]
        lists.append([{"start": s, "stop": s + rng.randrange(1, 60)} for s in starts])
    got = list(repeats._merger(40).func(iter([pa.array(lists, RANGES), pa.array([], RANGES), pa.array(lists[5:9], RANGES)])))
    assert [x.to_pylist() for x in got] == [[plain(x, 40) for x in some] for some in (lists, [], lists[5:9])]
    assert all(x.type == RANGES for x in got)


def test_many_starts_of_a_text_are_no_python_objects(spark):
    """A text of which every window repeats has a range for each start."""
    rows = pa.array([[{"start": i, "stop": i + 1} for i in range(100_000)]], RANGES)
    tracemalloc.start()
    got = list(repeats._merger(400).func(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0].to_pylist() == [[{"start": 0, "stop": 100_399}]]
    assert peak < 12 << 20
