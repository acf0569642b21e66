"""Whole runs as one plan: from detections to records, and from records and truth to the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.numbers import coordinate, milliseconds
from tagloom.functions.payload import json_in
from tagloom.functions.text import strip
from tagloom.operators import cascade, overlay, tracks
from tagloom.operators.evaluation import kpi_correct
from tagloom.operators.matching import code_join, greedy_match, match_names, matching_edges, place_join
from tagloom.schema import COORDINATES, KPI_FIELDS, archetypes
from tagloom.session import cut_lineage

KEYS = cascade.KEYS
PICKED = ["seq", "ts_ms", "x1", "y1", "x2", "y2"]


def resolve_run(
    detections: DataFrame,
    decoded: DataFrame,
    reads: DataFrame,
    fallback: DataFrame | None = None,
    payloads: DataFrame | None = None,
    gallery: DataFrame | None = None,
    skip_fallback: bool = False,
    qr_candidates: int = 3,
) -> DataFrame:
    """One row for each track: its best frame's time and place, all fields, and where code and payload came from.

    * detections (video, track_id, path, seq, ts_ms, x1, y1, x2, y2, area, sharpness, touches_edge)
    * decoded (video, track_id, seq, variant_idx, text): what the code decoder gave
    * reads (video, track_id, raw): the reader's raw answer for the best frame; its own code is the second choice
    * fallback (video, track_id, seq, sharpness, text): the reader's codes of single frames
    * payloads (video, track_id, seq, payload, source): decoded two-dimensional codes, of which those of the best
      frame and of up to ``qr_candidates`` - 1 frames along the track are looked at, in this order; None skips them
    * gallery (ord, entry): names that product names are brought to

    Tracks without a frame have no row; those without reads have blank fields.
    """
    picked = tracks.pick_best(detections, KEYS).select(*KEYS, "path", *PICKED)
    inline = reads.select(*KEYS, strip(F.try_element_at(json_in(F.col("raw")), F.lit("barcode"))).alias("text"))
    codes = cascade.resolve_barcodes(picked, decoded, inline, fallback, skip_fallback)
    if payloads is None:
        first = picked.limit(0).select(*KEYS, F.lit("").alias("payload"), F.lit("").alias("qr_source"))
    else:
        candidates = tracks.scan_candidates(detections, picked, qr_candidates, KEYS)
        first = cascade.first_payload(candidates.join(payloads, [*KEYS, "seq"]))
    out = cascade.assemble(picked, reads, codes, first, archetypes(detections.sparkSession))
    if gallery is not None:
        out = cut_lineage(out)  # a row for each track, read several times from here on
        found = match_names(out, gallery, "product_name").select(F.col("name").alias("product_name"), F.col("canonical").alias("__name"))
        out = out.join(found, "product_name").withColumn("product_name", F.col("__name")).drop("__name")
    return out


def record_run(resolved: DataFrame) -> DataFrame:
    """The 29 columns of each row of ``resolve_run``."""
    return overlay.to_record(resolved, "path")


def match_run(pred: DataFrame, truth: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """(keys, p_ord, g_ord, rule) of records: by code, else by time and place; each true record once, predictions in order.

    A blank time or coordinate counts as 0; a time that can't be read has no place.
    """

    def side(rows: DataFrame, s: str) -> DataFrame:
        ts = F.when(F.coalesce("frame_timestamp", F.lit("")) == "", F.lit("0")).otherwise(F.col("frame_timestamp"))
        box = [coordinate(F.col(c)).alias(f"{s}_{b}") for c, b in zip(COORDINATES, ("x1", "y1", "x2", "y2"))]
        return rows.select(*keys, F.col(order).alias(f"{s}_ord"), strip(F.col("barcode")).alias(f"{s}_code"), milliseconds(ts).alias(f"{s}_ts"), *box)

    p, g = side(pred, "p"), side(truth, "g")
    by_code = code_join(p.select(*keys, "p_ord", "p_code"), g.select(*keys, "g_ord", "g_code"), keys)
    by_place = place_join(p.drop("p_code"), g.drop("g_code"), keys)
    return greedy_match(matching_edges(by_code, by_place, keys), keys)


def evaluate_run(pred: DataFrame, truth: DataFrame, keys: list[str], order: str = "line", share: float = 0.8) -> DataFrame:
    """One row: n_pred, n_gt, matched, recall, precision, kpi_pass_rate and the accuracy of each headline field (acc_*).

    pred and truth are records with their group (``keys``) and a number in it
    (``order``).  Fields whose truth is blank don't count; a match passes with
    ``share`` of the others right.  Without rows all shares are 0.
    """
    said = lambda rows, s: rows.select(*keys, F.col(order).alias(f"{s}_ord"), *[F.col(f).alias(f"{s}_{f}") for f in KPI_FIELDS])
    pairs = match_run(pred, truth, keys, order).join(said(pred, "p"), [*keys, "p_ord"]).join(said(truth, "g"), [*keys, "g_ord"])
    there = {f: strip(F.col(f"g_{f}")) != "" for f in KPI_FIELDS}
    pairs = pairs.select(*[F.when(there[f], kpi_correct(f, F.col(f"p_{f}"), F.col(f"g_{f}"))).alias(f) for f in KPI_FIELDS])  # null: doesn't count
    total = lambda what: reduce(Column.__add__, [F.when(what(F.col(f)), 1).otherwise(0) for f in KPI_FIELDS])
    passed = (total(lambda c: c.isNotNull()) > 0) & (total(lambda c: F.coalesce(c, F.lit(False))) / F.greatest(total(lambda c: c.isNotNull()), F.lit(1)) >= share)
    per_field = [(F.count_if(F.col(f)) / F.greatest(F.count(f), F.lit(1))).alias(f"acc_{f}") for f in KPI_FIELDS]
    matched = pairs.agg(F.count(F.lit(1)).alias("matched"), F.count_if(passed).alias("passed"), *per_field)
    one = pred.agg(F.count(F.lit(1)).alias("n_pred")).join(truth.agg(F.count(F.lit(1)).alias("n_gt"))).join(matched)  # one row each
    of = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return one.select("n_pred", "n_gt", "matched", of("matched", "n_gt").alias("recall"), of("matched", "n_pred").alias("precision"), of("passed", "matched").alias("kpi_pass_rate"), *[f"acc_{f}" for f in KPI_FIELDS])
