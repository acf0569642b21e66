"""Staged cascades: costly steps only for what cheaper ones left open."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.codes import ean13_valid
from tagloom.functions.payload import fields_of, json_in, parse_payload
from tagloom.functions.text import strip
from tagloom.operators import overlay, tracks, vote
from tagloom.schema import FIELDS, PAYLOAD_KEYS

KEYS = ["video", "track_id"]


def staged(rows: DataFrame, keys: list[str], stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], value: str = "barcode", source: str = "barcode_source") -> DataFrame:
    """(keys, value, source): each stage sees only the keys that all before it left open.

    A stage maps rows to (keys, value).  Python functions run for every row
    they are given, also under a condition, so the open rows are filtered
    before each stage rather than inside one expression.
    """
    open_, done = rows, None
    for name, stage in stages:
        found = stage(open_).filter(F.coalesce(F.col(value), F.lit("")) != "").select(*keys, F.col(value), F.lit(name).alias(source))
        done = found if done is None else done.unionByName(found)
        open_ = open_.join(found.select(*keys), keys, "left_anti")
    rest = open_.select(*keys).distinct().withColumn(value, F.lit("")).withColumn(source, F.lit("none"))
    return rest if done is None else done.unionByName(rest)


def resolve_barcodes(track_keys: DataFrame, attempts: DataFrame, inline: DataFrame, fallback: DataFrame | None, skip_fallback: bool = False, k: int = 3) -> DataFrame:
    """Code of each track: decoded, read inline, voted by the reader over its sharpest frames, or none.

    attempts: (keys, seq, variant_idx, text); inline: (keys, text); fallback:
    (keys, seq, sharpness, text).  Sources: zxing, vlm_inline,
    skipped_fallback, vlm_fallback, none.
    """
    valid = ean13_valid(F.col("text"))

    def decoded(open_: DataFrame) -> DataFrame:
        a = attempts.join(open_.select(*KEYS), KEYS, "left_semi")
        return vote.first_success(a, KEYS, valid, ["seq", "variant_idx"]).select(*KEYS, F.col("text").alias("barcode"))

    def read(open_: DataFrame) -> DataFrame:
        return inline.join(open_.select(*KEYS), KEYS, "left_semi").filter(valid).select(*KEYS, F.col("text").alias("barcode"))

    def voted(open_: DataFrame) -> DataFrame:
        top = tracks.top_frames(fallback.join(open_.select(*KEYS), KEYS, "left_semi"), k, KEYS)
        return vote.majority(top.filter(valid), KEYS, "text", "rank").select(*KEYS, F.col("text").alias("barcode"))

    stages = [("zxing", decoded), ("vlm_inline", read)]
    if fallback is not None and not skip_fallback:
        stages.append(("vlm_fallback", voted))
    out = staged(track_keys.select(*KEYS).distinct(), KEYS, stages)
    if skip_fallback:
        out = out.withColumn("barcode_source", F.when(F.col("barcode_source") == "none", "skipped_fallback").otherwise(F.col("barcode_source")))
    return out


def first_payload(qr_attempts: DataFrame) -> DataFrame:
    """(keys, payload, source): the first candidate that gave anything."""
    some = qr_attempts.filter(F.coalesce("payload", F.lit("")) != "")
    return some.groupBy(*KEYS).agg(F.min_by(F.struct("payload", "source"), "cand_idx").alias("x")).select(*KEYS, "x.payload", F.col("x.source").alias("qr_source"))


def assemble(picked: DataFrame, reads: DataFrame, barcodes: DataFrame, payloads: DataFrame, archetypes: DataFrame) -> DataFrame:
    """Reader fields, then codes, payload overlay, code fill and routing, for each picked frame."""
    fields = reads.select(*KEYS, *fields_of(json_in(F.col("raw"))))
    x = picked.join(fields, KEYS, "left").join(barcodes.withColumnsRenamed({"barcode": "__code"}), KEYS, "left")
    x = x.withColumns({f: F.coalesce(f, F.lit("")) for f in FIELDS})
    x = x.withColumn("barcode", F.coalesce("__code", F.lit(""))).drop("__code")
    parsed = payloads.withColumn("__m", parse_payload(F.col("payload")))
    said = [c for c in ("payload", "qr_source") if c in payloads.columns]
    parsed = parsed.select(*KEYS, *said, *[strip(F.try_element_at("__m", F.lit(f))).alias(f"__qr_{f}") for f in PAYLOAD_KEYS])
    x = overlay.overlay_fields(x.join(parsed, KEYS, "left"), list(PAYLOAD_KEYS), "__qr_")
    return overlay.route(overlay.fill_barcode(x), archetypes)


def detect_only(picked: DataFrame, path: str) -> DataFrame:
    """Records with the place filled in and all fields blank."""
    return overlay.to_record(picked, path)
