"""Summarise stage times from a Spark event log folder (as written by
``BENCH_EVENT_LOG=<folder> python bench.py``): slowest stages first.

usage: python scripts/stage_times.py <event-log-folder> [top_n]
"""

from __future__ import annotations

import io
import json
import pathlib
import sys


def _lines(path: pathlib.Path):
    raw = path.read_bytes()
    if path.suffix == ".zstd":
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    yield from raw.decode("utf-8", "replace").splitlines()


def main() -> None:
    root = pathlib.Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages = []
    for f in sorted(root.rglob("events_*")):
        for line in _lines(f):
            if '"SparkListenerStageCompleted"' not in line:
                continue
            info = json.loads(line)["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                               info["Stage Name"][:60]))
    stages.sort(reverse=True)
    print("ms\tstage\ttasks\tname")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms}\t{sid}\t{tasks}\t{name}")
    print(f"stages: {len(stages)}, total stage ms: {sum(s[0] for s in stages)}")


if __name__ == "__main__":
    main()
