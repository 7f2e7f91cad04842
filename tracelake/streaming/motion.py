"""Incremental traces: motion energy of frames that arrive in order, with the frame before as state.

Each run keeps its next frame number and its last boxes' pixels, and the boxes' pixels
of frames beyond a gap until it closes: a run's result is a prefix without holes, in
whatever batches its frames come. A gap that doesn't close is given up when more than
``most`` frames wait behind it, or when its run has been quiet for ``quiet_ms``: it is
reported as a row without a box, of its first missing frame and how many are missing, and
what waits goes on without a frame before. Frames that come later than that are dropped,
as are repeated ones. Running sums are plain streaming aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRACES = "run string, box string, frame long, lum double, me double, missing long"
#: Frames that wait behind a gap, at most.
MOST = 4096


def motion_traces(frames: DataFrame, boxes: list[tuple[str, int, int, int, int]], most: int = MOST, quiet_ms: int | None = None) -> DataFrame:
    """(run, box, frame, lum, me, missing) from a stream of frames (run, frame, h, w, pixels); ``boxes``: (name, x0, y0, x1, y1).

    ``missing`` is null but for a gap's row. ``quiet_ms`` needs a stream that goes on, as
    its timer is looked at with each batch.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        expected, held, ahead, pixels = state.get if state.exists else (0, b"", [], [])
        before = np.frombuffer(held, np.float64) if held else None
        waiting = {f: np.frombuffer(p, np.float64) for f, p in zip(ahead, pixels, strict=True)}
        if not state.hasTimedOut:
            for part in parts:
                for r in part.itertuples():
                    if r.frame < expected or r.frame in waiting:
                        continue  # seen before, or given up
                    image = np.asarray(r.pixels, np.float64).reshape(r.h, r.w)
                    cuts = [image[y0:y1, x0:x1].ravel() for _, x0, y0, x1, y1 in boxes]
                    # boxes' sizes, which the image's edge may cut, then their pixels
                    waiting[int(r.frame)] = np.concatenate([[float(len(c)) for c in cuts], *cuts])
        rows = []
        while waiting:
            if expected not in waiting:
                if len(waiting) <= most and not state.hasTimedOut:
                    break
                upto = min(waiting)
                rows.append((key[0], None, expected, None, None, upto - expected))
                expected, before = upto, None
            now, at = waiting.pop(expected), len(boxes)
            for (name, *_), size in zip(boxes, now[: len(boxes)].astype(int), strict=True):
                cut, old = now[at : at + size], None if before is None else before[at : at + size]
                if size:
                    rows.append((key[0], name, expected, cut.mean(), 0.0 if old is None else float(np.abs(cut - old).mean()), None))
                at += size
            before, expected = now, expected + 1
        late = sorted(waiting)
        state.update((expected, b"" if before is None else before.tobytes(), late, [waiting[f].tobytes() for f in late]))
        if quiet_ms is not None and late:
            state.setTimeoutDuration(quiet_ms)
        yield pd.DataFrame(rows, columns=["run", "box", "frame", "lum", "me", "missing"]).astype({"missing": "Int64"})

    kept = "expected long, last binary, ahead array<long>, pixels array<binary>"
    return frames.groupBy("run").applyInPandasWithState(step, TRACES, kept, "append", "NoTimeout" if quiet_ms is None else "ProcessingTimeTimeout")


def running_moments(traces: DataFrame) -> DataFrame:
    """(run, channel, n, mean, sd) so far; for update or complete mode."""
    return traces.groupBy("run", "channel").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))


def read_frames(spark: SparkSession, path: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    """A folder to which frames are still uploaded; each file is taken once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_traces(traces: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to Parquet; the checkpoint makes reruns take only what is new."""
    writer = traces.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
