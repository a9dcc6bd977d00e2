"""Slowest stages from a Spark event log folder (no UI, no server).

    python tools/stage_times.py <event-log-folder> [top_n]
"""
from __future__ import annotations

import io
import json
import pathlib
import sys


def _lines(path: pathlib.Path):
    """Event log lines; Spark 4 writes rolling, zstd-compressed files."""
    if path.suffix == ".zstd":
        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    folder = pathlib.Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for log in sorted(folder.rglob("*")):
        if not log.is_file() or log.name.startswith((".", "appstatus")):
            continue
        for line in _lines(log):
            event = json.loads(line)
            if event.get("Event") != "SparkListenerStageCompleted":
                continue
            info = event["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:8.2f}s  stage {sid:5d}  tasks {tasks:5d}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f}s in total")


if __name__ == "__main__":
    main()
