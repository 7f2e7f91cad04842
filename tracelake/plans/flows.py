"""Whole flows over batches of recordings: what a command does for one run, as tables of all runs.

A run that can't be read doesn't stop the others: what is wrong with it is a row of
``outcomes`` (run, status: ok, flagged or failed, reason), and only sound runs go on.
What a later step reads again is written once to the shared folder.

Cases: an empty batch gives empty tables; a run without boxes, or without frames where
some are expected, has failed; null pixels count as zero; frames of a run are distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.operators import checks as C
from tracelake.operators import images as I
from tracelake.sources import tiff
from tracelake.sources.shared import stored


@dataclass(frozen=True)
class Extraction:
    """Parameters of ``calcium``: frames in a bin, the map's threshold, sizes of regions, seeds to try."""

    bin: int = 5
    threshold: float = 0.4
    least: int = 9
    most: int = 400
    attempts: int | None = None
    cap: int | None = None
    border: int = 5
    upsample: int = 10
    smooth: float = 0.0
    percentile: float = 0.15
    most_shift: float = 10.0
    least_rois: int = 10


def soundness(frames: DataFrame, expected: DataFrame) -> DataFrame:
    """(run, reason) of every run of ``expected`` (run, expected): null where all its frames are there, readable or not marked as such."""
    whole = C.complete_runs(frames, expected, refuse=False)
    reason = F.when(F.col("n") == 0, "no frames").when(~F.col("ok"), F.concat(F.col("n").cast("string"), F.lit(" of "), F.col("expected").cast("string"), F.lit(" frames")))
    if "error" not in frames.columns:
        return whole.select("run", reason.alias("reason"))
    broken = C.truncations(frames).select("run", F.concat(F.lit("frame "), F.col("at_frame").cast("string"), F.lit(": "), F.col("reason")).alias("cut"))
    return whole.join(broken, "run", "left").select("run", F.coalesce("cut", reason).alias("reason"))


def boxes_for(runs: DataFrame, own: DataFrame, template: DataFrame | None = None, anew: bool = False) -> DataFrame:
    """(run, box, x0, y0, x1, y1) of every run: its own boxes, else the template's (box, x0, ..).

    ``anew`` gives every run the template's. A run has all boxes of one kind or of the
    other, never some of both; without a template, runs without boxes have none.
    """
    mine = own.join(runs.select("run").distinct(), "run", "left_semi").select("run", "box", "x0", "y0", "x1", "y1")
    if template is None:
        return mine
    bare = runs.select("run").distinct() if anew else runs.select("run").distinct().join(mine.select("run").distinct(), "run", "left_anti")
    # one row with the template's few boxes, for each run
    given = template.agg(F.collect_list(F.struct("box", "x0", "y0", "x1", "y1")).alias("b"))
    filled = bare.crossJoin(F.broadcast(given)).select("run", F.inline("b"))
    return filled if anew else mine.unionByName(filled)


def behaviour(frames: DataFrame, boxes: DataFrame, expected: DataFrame, area_level: float = 10.0, strict: bool = True, template: DataFrame | None = None) -> dict[str, DataFrame]:
    """``traces`` (run, box, frame, lum, me, power, area) of all sound runs, ``problems`` of their boxes, and ``outcomes``.

    ``frames``: (run, frame, h, w, pixels, and part and error if reading can fail).
    Box errors fail a run, box warnings flag it. Unless ``strict``, a run whose frames end
    early keeps those before the first that can't be read: it is truncated, not failed.
    ``template``: boxes (box, x0, ..) of runs that have none.
    """
    boxes = boxes_for(expected, boxes, template)
    if not strict:
        whole = frames if "error" in frames.columns else frames.withColumn("error", F.lit(None).cast("string"))
        cut = stored(soundness(frames, expected), "cut")
        kept = stored(C.contiguous_prefix(whole).select("run", "frame", "h", "w", "pixels"), "kept")
        some = kept.groupBy("run").agg(F.count_distinct("frame").cast("int").alias("expected"))
        out = behaviour(kept, boxes, expected.select("run").join(some, "run", "left").select("run", F.coalesce("expected", F.lit(1)).alias("expected")), area_level)
        late = out["outcomes"].join(cut.withColumnRenamed("reason", "short"), "run", "left")
        status = F.when((F.col("status") != "failed") & F.col("short").isNotNull(), "truncated").otherwise(F.col("status"))
        return out | {"outcomes": late.select("run", status.alias("status"), F.coalesce("reason", "short").alias("reason"))}
    problems = stored(C.box_problems(boxes), "problems")
    errors = problems.filter("level = 'error'").groupBy("run").agg(F.concat(F.lit("box "), F.min("problem")).alias("wrong"))
    boxed = boxes.select("run").distinct().withColumn("boxed", F.lit(True))
    state = soundness(frames, expected).join(errors, "run", "left").join(boxed, "run", "left")
    state = state.select("run", F.coalesce("reason", "wrong", F.when(F.col("boxed").isNull(), "no boxes")).alias("reason"))
    noted = problems.filter("level = 'warning'").select("run").distinct().withColumn("noted", F.lit(True))
    outcomes = stored(_outcomes(state.join(noted, "run", "left"), "noted"), "outcomes")
    sound = outcomes.filter("status <> 'failed'").select("run")
    pixels = I.to_pixels(frames.join(sound, "run", "left_semi").select("run", "frame", "h", "w", "pixels"))
    return {"traces": I.box_traces(pixels, boxes, area_level), "problems": problems, "outcomes": outcomes}


def calcium(frames: DataFrame, expected: DataFrame, params: Extraction = Extraction()) -> dict[str, DataFrame]:
    """Registration, correlation map, regions and traces of all sound runs.

    ``shifts``, ``map``, ``rois`` (table), ``roi_pixels``, ``traces`` (run, roi, frame, f, f0, dff)
    and ``outcomes``; runs that move far or have few regions are flagged.
    """
    state = stored(soundness(frames, expected), "state")
    sound = frames.join(state.filter("reason is null").select("run"), "run", "left_semi").select("run", "frame", "h", "w", "pixels")
    moved, shifts = I.register(sound, params.upsample, params.smooth)
    moved = stored(moved, "moved")
    final = shifts.filter("pass = 2").drop("pass")
    pixels = I.to_pixels(moved)
    binned = stored(I.to_frames(I.bin_frames(pixels, params.bin)), "binned")
    cmap = stored(I.zero_border(I.correlation_map(binned), I.border_of(final, params.border)), "map")
    found = stored(I.dense_labels(I.regions(binned, cmap, params.threshold, params.least, params.most, params.attempts, cap=params.cap)), "regions")
    traces = I.dff_traces(I.roi_traces(pixels, found), params.percentile)
    far = final.groupBy("run").agg((F.percentile(F.hypot("dy", "dx"), F.lit(0.99)) > params.most_shift).alias("far"))
    rois = found.groupBy("run").agg(F.count_distinct("roi").alias("n"))
    flagged = state.join(far, "run", "left").join(rois, "run", "left").withColumn("flag", F.coalesce("far", F.lit(False)) | (F.coalesce("n", F.lit(0)) < params.least_rois))
    return {"shifts": shifts, "map": cmap, "rois": I.roi_table(found), "roi_pixels": found, "traces": traces, "outcomes": _outcomes(flagged, "flag")}


def _outcomes(state: DataFrame, flag: str) -> DataFrame:
    status = F.when(F.col("reason").isNotNull(), "failed").when(F.coalesce(flag, F.lit(False)), "flagged").otherwise("ok")
    return state.select("run", status.alias("status"), "reason")


def exit_code(outcomes: DataFrame) -> int:
    """What a command says of a batch: 2 with failed runs, 3 with flagged ones, else 0."""
    counts = outcomes.groupBy().agg(F.count_if(F.col("status").isin("failed", "truncated")).alias("failed"), F.count_if(F.col("status") == "flagged").alias("flagged")).first()
    return 2 if counts["failed"] else 3 if counts["flagged"] else 0


def verify(files: DataFrame) -> dict[str, DataFrame]:
    """Whether listed image files (path, folder, name) are readable to their end, before a batch is begun.

    ``files``: (run, path, frames, problem), where only a file's first and last image are
    read; ``outcomes``: (run, status, reason), failed where a file is short or unreadable.
    """
    pages = stored(tiff.index(files), "pages")
    ends = pages.groupBy("run", "path").agg(F.min(F.when(F.col("error").isNull(), F.col("page"))).alias("a"), F.max(F.when(F.col("error").isNull(), F.col("page"))).alias("b"), F.count_if(F.col("error").isNull()).alias("frames"), F.min("error").alias("said"))
    looked = tiff.pixels_of(pages.join(ends.select("path", "a", "b"), "path").filter("page = a or page = b").drop("a", "b"))
    wrong = looked.join(pages.select("run", "part", "path").distinct(), ["run", "part"]).groupBy("path").agg(F.min("error").alias("unread"))
    found = stored(ends.join(wrong, "path", "left").select("run", "path", "frames", F.coalesce("said", "unread", F.when(F.col("frames") == 0, "no readable pages")).alias("problem")), "verified")
    each = found.groupBy("run").agg(F.min(F.when(F.col("problem").isNotNull(), F.concat(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(": "), F.col("problem")))).alias("reason"))
    return {"files": found, "outcomes": each.select("run", F.when(F.col("reason").isNull(), "ok").otherwise("failed").alias("status"), "reason")}
