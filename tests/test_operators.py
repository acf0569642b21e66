import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.operators import cascade, datasets, evaluation, matching, overlay, sampling, summary, tracks, validate, vote
from tagloom.schema import COLUMNS, FIELDS, KPI_FIELDS, archetypes

K = ["video", "track_id"]


def frames(spark, rows):
    """(track, seq, area, sharpness, edge)"""
    return spark.createDataFrame([("v", *r) for r in rows], "video string, track_id int, seq int, area double, sharpness double, touches_edge boolean")


def brute_best(rows):
    out = {}
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for t, part in by.items():
        areas = sorted(r[2] for r in part)
        at = 0.75 * (len(areas) - 1)
        low = areas[int(at)]
        p75 = low + (areas[min(int(at) + 1, len(areas) - 1)] - low) * (at - int(at))
        full = [r for r in part if r[2] >= 0.75 * p75]
        tiers = [[r for r in full if not r[4]], full, [r for r in part if not r[4]], part]
        tier = next(x for x in tiers if x)
        out[t] = min(tier, key=lambda r: (-r[3], r[1]))[1]
    return out


def test_pick_best(spark):
    rng = random.Random(1)
    rows = [(t, s, float(rng.choice([1, 2, 10, 100])), float(rng.randrange(3)), rng.random() < 0.5) for t in range(40) for s in range(rng.randrange(1, 7))]
    got = {r.track_id: r.seq for r in tracks.pick_best(frames(spark, rows)).collect()}
    assert got == brute_best(rows)


def test_pick_best_tiers_and_ties(spark):
    rows = [(1, 0, 100.0, 5.0, True), (1, 1, 100.0, 1.0, False), (2, 0, 10.0, 5.0, False), (2, 1, 10.0, 5.0, False), (3, 0, 1000.0, 1.0, True), (3, 1, 10.0, 9.0, False)]
    got = {r.track_id: (r.seq, r.tier) for r in tracks.pick_best(frames(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 2)}


def test_track_helpers(spark):
    rows = [(1, s, 1.0, float(s % 3), False) for s in range(10)] + [(2, 5, 1.0, 1.0, False)]
    df = frames(spark, rows)
    assert [(r.track_id, r.n_frames, r.first_seen) for r in tracks.summarise_tracks(df).orderBy("track_id").collect()] == [(1, 10, 0), (2, 1, 5)]
    assert sorted((r.track_id, r.seq) for r in tracks.top_frames(df, 3).collect()) == [(1, 2), (1, 5), (1, 8), (2, 5)]
    assert sorted(r.seq for r in tracks.every_nth(df.filter("track_id = 1"), 4, K).collect()) == [3, 7]
    picked = df.filter("(track_id = 1 AND seq = 7) OR track_id = 2")
    got = sorted((r.track_id, r.cand_idx, r.seq) for r in tracks.scan_candidates(df, picked, 3).collect())
    assert got == [(1, 0, 7), (1, 1, 0), (1, 2, 5), (2, 0, 5), (2, 1, 5)]
    assert [r.track_id for r in tracks.long_tracks(df, 2).collect()] == [1]
    assert [r.n_frames for r in tracks.longest_tracks(df, 1).collect()] == [10]


def test_votes(spark):
    rows = [("v", 1, 0, "b"), ("v", 1, 1, "a"), ("v", 1, 2, "a"), ("v", 1, 3, "b"), ("v", 2, 0, None)]
    df = spark.createDataFrame(rows, "video string, track_id int, rank int, code string")
    assert [(r.track_id, r.code, r.votes) for r in vote.majority(df, K).collect()] == [(1, "b", 2)]
    assert vote.histogram(df, K).first().votes == {"a": 2, "b": 2}
    got = {r.track_id: (r.code, r.tried) for r in vote.first_success(df, K, F.col("code") == "a", ["rank"], "code").collect()}
    assert got == {1: ("a", 2), 2: (None, 1)}


def test_overlay_and_fill(spark):
    df = spark.createDataFrame([("", "x"), ("нет", "x"), (" ", " y "), ("z", "x"), ("z", ""), (None, None)], "t string, s string")
    assert [r[0] for r in df.select(overlay.fill_blank(F.col("t"), F.col("s"))).collect()] == ["x", "нет", "y", "z", "z", ""]
    assert [r[0] for r in df.select(overlay.overlay(F.col("t"), F.col("s"))).collect()] == ["x", "x", " y ", "x", "z", ""]


def test_route(spark):
    rows = [(" Red ", "", "", " x "), ("yellow", "-30%", "", ""), ("magenta", " ", "", "")]
    df = spark.createDataFrame(rows, "color string, discount_amount string, code string, barcode string")
    got = [tuple(r) for r in overlay.route(df, archetypes(spark)).collect()]
    assert got == [("Red", "", "нет", "x"), ("yellow", "-30%", "нет", ""), ("magenta", " ", "", "")]


def test_records_and_alignment(spark):
    df = spark.createDataFrame([("/d/v/a.mp4", 6595, 1.5, "red")], "path string, ts_ms int, x1 double, color string")
    r = overlay.to_record(df, "path").first().asDict()
    assert list(r) == COLUMNS and (r["filename"], r["frame_timestamp"], r["x_min"], r["color"], r["code"]) == ("v/a.mp4", "6595", "1.5", "red", "")
    whole = overlay.to_record(df, "path").withColumn("extra", F.lit(1))
    aligned, dropped = overlay.align_schema(whole)
    assert aligned.columns == COLUMNS and dropped == ["extra"]
    with pytest.raises(ValueError):
        overlay.align_schema(df)
    assert overlay.drop_service(df.withColumn("__trk_id", F.lit(1))).columns == df.columns


def test_interval_join(spark):
    rng = random.Random(2)
    a = [("k" + str(rng.randrange(2)), i, rng.randrange(-5000, 5000)) for i in range(60)]
    b = [("k" + str(rng.randrange(2)), i, rng.randrange(-5000, 5000)) for i in range(60)] + [("k0", 99, a[0][2] + 1500), ("k0", 98, a[0][2] + 1501)]
    got = sorted((r.i, r.j) for r in matching.interval_join(spark.createDataFrame(a, "k string, i int, t long"), spark.createDataFrame(b, "k string, j int, u long"), ["k"], "t", "u", 1500).collect())
    assert got == sorted((i, j) for k, i, t in a for m, j, u in b if k == m and abs(t - u) <= 1500)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("few", [1000, 0])
def test_code_join_loses_nothing(spark, monkeypatch, few):
    monkeypatch.setattr(matching, "FEW_CODES", few)
    rng = random.Random(5)
    p = ["".join(rng.choice("0123456789") for _ in range(13)) for _ in range(25)] + ["short"]
    g = []
    for c in p[:25]:
        for _ in range(4):
            x = list(c)
            for _ in range(rng.randrange(4)):
                i = rng.randrange(len(x))
                x[i : i + 1] = rng.choice([[], [rng.choice("0123456789")], [x[i], "7"]])
            g.append("".join(x)[rng.choice([0, 0, 1, 3]) :])

    def match(a, b):
        n = min(len(a), len(b), 10)
        return bool(b) and (edit(a, b) <= 2 or len(a) != len(b) and n >= 8 and (edit(a[-n:], b[-n:]) <= 2 or edit(a[:n], b[:n]) <= 2))

    pd, gd = spark.createDataFrame([("v", i, c) for i, c in enumerate(p)], "v string, i int, p_code string"), spark.createDataFrame([("v", j, c) for j, c in enumerate(g)], "v string, j int, g_code string")
    got = sorted((r.i, r.j) for r in matching.code_join(pd, gd, ["v"]).collect())
    assert got == sorted((i, j) for i, a in enumerate(p) for j, b in enumerate(g) if len(a) == 13 and match(a, b))


def brute_greedy(edges):
    out = []
    for v in sorted({e[0] for e in edges}):
        used = set()
        mine = sorted((p, r, g) for w, p, g, r in edges if w == v)
        for p in sorted({e[0] for e in mine}):
            for _, r, g in (e for e in mine if e[0] == p):
                if g not in used:
                    used.add(g)
                    out.append((v, p, g, r))
                    break
    return sorted(out)


def test_greedy_match(spark):
    rng = random.Random(3)
    edges = list({("v" + str(rng.randrange(4)), rng.randrange(8), rng.randrange(8), rng.choice([1, 2])) for _ in range(90)})
    df = spark.createDataFrame(edges, "v string, p_ord int, g_ord int, rule int")
    assert sorted(map(tuple, matching.greedy_match(df, ["v"]).collect())) == brute_greedy(edges)
    for rounds in (40, 1):  # large groups: in rounds, and the rest as a stream
        assert sorted(map(tuple, matching.greedy_match(df, ["v"], stream_edges=3, rounds=rounds).collect())) == brute_greedy(edges)


def test_greedy_match_of_one_large_group(spark):
    """One video: most of it is settled in rounds, spread over tasks; null keys and predictions that all want the same."""
    rng = random.Random(8)
    edges = list({(None, p, p // 2 + rng.randrange(40), rng.choice([1, 2])) for p in range(3000) for _ in range(5)}) + [("w", p, g, 2) for p in range(30) for g in range(30)]
    df = spark.createDataFrame(edges, "v string, p_ord long, g_ord long, rule int").repartition(4)
    want = sorted([(None, *e[1:]) for e in brute_greedy([("", *e[1:]) for e in edges if e[0] is None])] + brute_greedy([e for e in edges if e[0]]), key=repr)
    assert sorted(map(tuple, matching.greedy_match(df, ["v"], stream_edges=1000, rounds=8).collect()), key=repr) == want


def test_greedy_query(spark, sf_dir):
    from tagloom.plans import catalog

    e = [(r.user_id, r.event_id, r.event_type, int(r.ts.timestamp() * 1000)) for r in spark.read.parquet(f"{sf_dir}/events.parquet").collect()]
    c, p = [x for x in e if x[2] == "click"], [x for x in e if x[2] == "purchase"]
    edges = [(a[0], a[1], b[1], 2) for a in c for b in p if a[0] == b[0] and abs(a[3] - b[3]) <= 6 * 3_600_000]
    got = sorted((r.user_id, r.p_ord, r.g_ord, r.rule) for r in catalog.queries()["greedy_match"](spark, sf_dir).collect())
    assert got == brute_greedy(edges)


def test_gallery(spark):
    gallery = spark.createDataFrame([(0, "Молоко отборное"), (1, "Сыр российский"), (2, "Сыр  РОССИЙСКИЙ"), (3, "Хлеб"), (4, " ")], "ord int, entry string")
    names = spark.createDataFrame([("Молоко отборное",), ("Малоко отборное",), ("сыр российский",), ("совсем другое имя",), ("",), (" ",)], "name string")
    got = {r.name: (r.canonical, round(r.score, 9)) for r in matching.match_names(names, gallery).collect()}
    assert got == {"Молоко отборное": ("Молоко отборное", 1.0), "Малоко отборное": ("Молоко отборное", round(14 / 15, 9)), "сыр российский": ("Сыр российский", 1.0), "совсем другое имя": ("совсем другое имя", 0.0), "": ("", 0.0), " ": (" ", 0.0)}
    got = {r.name: r.canonical for r in matching.match_names(names, gallery.limit(0)).collect()}
    assert len(got) == 6 and all(a == b for a, b in got.items())


def test_gallery_compares_lengths_at_the_very_bound(spark):
    """A score of exactly 0.55 counts, whichever text is the longer."""
    pairs = [(33, 60), (66, 120), (55, 100), (99, 180), (110, 200), (100, 55), (180, 99), (200, 110)]
    names = [(chr(97 + i) * a,) for i, (a, _) in enumerate(pairs)]
    entries = [(i, chr(97 + i) * b) for i, (_, b) in enumerate(pairs)]
    gallery = spark.createDataFrame(entries, "ord int, entry string")
    got = {r.name: r.canonical for r in matching.match_names(spark.createDataFrame(names, "name string"), gallery).collect()}
    assert got == {n: e for (n,), (_, e) in zip(names, entries)}


def best_entry(name, entries, least=0.55):
    q = " ".join(name.lower().split())
    scored = [(1 - edit(q, g) / max(len(q), len(g)), -i, e) for i, (e, g) in enumerate((e, " ".join(e.lower().split())) for e in entries) if q and g]
    s, _, e = max(scored, default=(0.0, 0, name))
    return (e, round(s, 9)) if s >= least else (name, 0.0)


def test_gallery_against_all_pairs(spark):
    """Names near and far, repeated entries, few letters so that edit distances are close to each other."""
    rng = random.Random(6)
    for letters in ("ab ", "abcdefgh ", "абвгдежзиклмн ёй"):
        entries = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 25))) for _ in range(120)] + ["  Ab  a"] * 3
        names = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 25))) for _ in range(60)]
        for e in rng.sample(entries, 60):
            x = list(e)
            for _ in range(rng.randrange(6)):
                i = rng.randrange(len(x) + 1)
                x[i : i + rng.randrange(2)] = rng.choice(letters) * rng.randrange(2)
            names.append("".join(x))
        got = {r.name: (r.canonical, round(r.score, 9)) for r in matching.match_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(list(enumerate(entries)), "ord int, entry string")).collect()}
        assert got == {n: best_entry(n, entries) for n in names}


def test_gallery_compares_few_of_many(spark):
    """20,000 entries: names with some edits, and ones that are in none."""
    rng = random.Random(9)
    words = ["".join(rng.choice("абвгдежзиклмнопрстуфхцчшщэюя") for _ in range(rng.randrange(3, 10))) for _ in range(3000)]
    entries = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 5))) for _ in range(20_000)]
    names = [e[:5] + "х" + e[6:-1] for e in entries[:150]] + [" ".join(rng.choice(words) for _ in range(3)) for _ in range(50)]
    gallery = spark.createDataFrame(list(enumerate(entries)), "ord int, entry string").repartition(4)
    compared = matching.name_pairs(spark.createDataFrame([(n,) for n in names], "name string"), gallery, 0.55).count()
    assert 150 <= compared < len(entries) * len(names) / 10


def test_lookup_joins(spark):
    rows = spark.createDataFrame([("d", "a/x.jpg"), ("d", "y.jpg"), ("d", "z.jpg")], "dir string, name string")
    files = spark.createDataFrame([("d/x.jpg",), ("d/y.jpg",)], "path string")
    out, count = matching.resolve_files(rows, files, "dir", "name")
    assert sorted((r.name, r.found) for r in out.collect()) == [("a/x.jpg", "d/x.jpg"), ("y.jpg", "d/y.jpg"), ("z.jpg", None)]
    assert tuple(count.first()) == (2, 1)
    a = spark.createDataFrame([(1, "f1", "c1"), (1, "f2", "c2")], "ts int, file string, crop string")
    got = [tuple(r) for r in matching.artifact_join(spark.createDataFrame([(1,), (2,)], "ts int"), a, ["ts"], "file", ["crop"]).orderBy("ts").collect()]
    assert got == [(1, "c2"), (2, "")]
    kinds = spark.createDataFrame([("s", "mp4", "b"), ("s", "mov", "c"), ("s", "txt", "a")], "stem string, kind string, name string")
    assert [r.name for r in matching.prefer(kinds, ["stem"], "kind", ["mov", "mp4"], "name").collect()] == ["c"]


def test_field_rules(spark):
    df = spark.createDataFrame([("129.99", "129,99"), ("", ""), ("нет", "нет"), ("нет", ""), ("", "нет"), ("x", "нет"), ("130.02", "130.00"), ("131", "130.00")], "p string, g string")
    kpi = [r[0] for r in df.select(evaluation.kpi_correct("price_card", F.col("p"), F.col("g"))).collect()]
    assert kpi == [True, True, True, False, False, False, False, False]
    full = [r[0] for r in df.select(evaluation.field_correct("price_card", F.col("p"), F.col("g"))).collect()]
    assert full[:7] == [True, True, True, False, False, False, False]
    names = spark.createDataFrame([("Сыр", "сыр молодой"), ("сыр молодой", "Сыр")], "p string, g string")
    assert [r[0] for r in names.select(evaluation.field_correct("product_name", F.col("p"), F.col("g"))).collect()] == [True, True]
    assert [r[0] for r in names.select(evaluation.kpi_correct("product_name", F.col("p"), F.col("g"))).collect()] == [False, True]


def test_reports(spark):
    row = {f"{s}_{f}": "" for s in "pg" for f in FIELDS}
    rows = [{**row, "id": 1, "p_color": "red", "g_color": "Red", "p_price_card": "1.00", "g_price_card": "2.00"}, {**row, "id": 2, "p_color": "red", "g_color": "red"}]
    names = sorted(rows[0])
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {'int' if n == 'id' else 'string'}" for n in names))
    c = evaluation.compare_fields(df, ["id"])
    acc = {r.field: (r.ok, r.total, r.acc) for r in evaluation.report_order(evaluation.accuracy(c)).collect()}
    assert acc == {"color": (2, 2, 1.0), "price_card": (0, 1, 0.0)}
    o = evaluation.overall(c, sample="id").first()
    assert (o.macro_acc, o.micro_acc, o.sample_acc) == pytest.approx((0.5, 2 / 3, 0.75))
    assert [(r.field, r.id) for r in evaluation.first_failures(c, ["id"]).collect()] == [("price_card", 1)]
    k = evaluation.kpi_report(df, ["id"], 4, 2).first()
    assert (k.matched, k.recall, k.precision, k.kpi) == (2, 1.0, 0.5, 0.5)
    assert set(KPI_FIELDS) <= set(FIELDS)
    none = evaluation.kpi_report(df.limit(0), ["id"], 0, 0).first()
    assert (none.matched, none.recall, none.kpi) == (0, 0.0, 0.0)


def test_validation(spark):
    good = dict.fromkeys(COLUMNS, "") | {"frame_timestamp": "5", "price_card": "1,50", "price1_qr": "1.50", "barcode": "4670025474665", "id_sku": "12", "discount_amount": "-5%", "print_datetime": "01.02.2024 10:00", "x_min": "нет"}
    bad = {"frame_timestamp": "5.0", "price_card": "1.50", "price1_qr": "1,50", "barcode": "4670025474666", "qr_code_barcode": "12", "id_sku": "a", "discount_amount": "5%", "print_datetime": "2024-01-01", "x_min": "1"}
    rows = [(2, *[good[c] for c in COLUMNS])] + [(3 + i, *[(good | {k: v})[c] for c in COLUMNS]) for i, (k, v) in enumerate(bad.items())]
    df = spark.createDataFrame(rows, "line int, " + ", ".join(f"{c} string" for c in COLUMNS))
    assert sorted((r.line, r.column) for r in validate.violations(df).collect()) == sorted((3 + i, k) for i, k in enumerate(bad))
    assert len(validate.rules()) == 20
    assert validate.header_errors(["__trk_id", *COLUMNS]) == [] and len(validate.header_errors(COLUMNS[1:])) == 2


def test_sampling(spark):
    rng = random.Random(4)
    rows = [("v" + str(rng.randrange(3)), rng.randrange(10_000)) for _ in range(200)]
    want = []
    for v in ("v0", "v1", "v2"):
        last = None
        for t in sorted(t for w, t in rows if w == v):
            if last is None or t - last >= 500:
                want.append((v, t))
                last = t
    df = spark.createDataFrame(rows, "video string, ts long")
    assert sorted(map(tuple, sampling.min_gap(df, ["video"], "ts", 500).collect())) == sorted(want)
    ids = spark.range(103).repartition(7)
    split = {r.id: r.split for r in sampling.systematic_split(ids, ["id"], 0.1).collect()}
    assert [i for i in range(103) if split[i] == "val"] == list(range(0, 103, 10))
    assert sorted(r.n for r in sampling.numbered(ids, ["id"], start=2).collect()) == list(range(2, 105))
    a = sampling.shuffled_split([str(i) for i in range(20)], 0.25)
    assert a == sampling.shuffled_split([str(i) for i in reversed(range(20))], 0.25) and list(a.values()).count("val") == 5
    share = sampling.hashed_split(spark.range(4000), "id", 0.2).filter("split = 'val'").count()
    assert 650 < share < 950
    assert sampling.unfinished(spark.range(5), spark.range(3), ["id"]).count() == 2


def kept_times(times, gap):
    out = []
    for t in sorted(times):
        if not out or t - out[-1] >= gap:
            out.append(t)
    return out


@pytest.mark.parametrize("gap", [0, 1, 700, 40_000, 10**7])
def test_least_gap_over_ranges(spark, monkeypatch, gap):
    """One group over many ranges, small ones within a range, null groups, equal times; no group at all."""
    monkeypatch.setattr(sampling, "RANGE_ROWS", 50)
    rng = random.Random(gap)
    rows = [("hot", rng.randrange(100_000)) for _ in range(1500)] + [(f"v{rng.randrange(40)}", rng.randrange(50_000)) for _ in range(300)] + [(None, t) for t in range(0, 9000, 300)] + [("hot", None)]
    df = spark.createDataFrame(rows, "video string, ts long").repartition(3)
    want = [(v, t) for v in {v for v, _ in rows} for t in kept_times([t for w, t in rows if w == v and t is not None], gap)]
    got = sampling.min_gap(df, ["video"], "ts", gap)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(r.ts for r in sampling.min_gap(df, [], "ts", gap).collect()) == kept_times([t for _, t in rows if t is not None], gap)
    assert sampling.min_gap(df.limit(0), ["video"], "ts", gap).collect() == []


def test_exact_split(spark):
    ids = spark.range(1003).repartition(7)
    for share in (0.0, 0.1, 0.333, 1.0):
        split = {r.id: r.split for r in sampling.exact_split(ids, "id", share).collect()}
        assert list(split.values()).count("val") == round(1003 * share)
        assert split == {r.id: r.split for r in sampling.exact_split(ids.repartition(2), "id", share).collect()}
    other = {r.id for r in sampling.exact_split(ids, "id", 0.1, seed=1).filter("split = 'val'").collect()}
    assert other != {r.id for r in sampling.exact_split(ids, "id", 0.1).filter("split = 'val'").collect()}
    twice = sampling.exact_split(spark.createDataFrame([(None,)] * 50 + [(i,) for i in range(50)], "id long"), "id", 0.2)
    assert {r.n for r in twice.groupBy("id").agg(F.countDistinct("split").alias("n")).collect()} == {1} and twice.filter("split = 'val'").count() <= 20
    assert sampling.exact_split(ids.limit(0), "id", 0.5).count() == 0


def test_barcode_cascade(spark):
    good, other = "4670025474665", "4600000000008"
    attempts = spark.createDataFrame([("v", 1, 0, 0, "12"), ("v", 1, 1, 3, good), ("v", 2, 0, 0, None)], "video string, track_id int, seq int, variant_idx int, text string")
    inline = spark.createDataFrame([("v", 1, other), ("v", 2, other), ("v", 3, "bad")], "video string, track_id int, text string")
    fallback = spark.createDataFrame([("v", 3, s, float(-s), t) for s, t in enumerate([good, other, other, good, good])], "video string, track_id int, seq int, sharpness double, text string")
    keys = spark.createDataFrame([("v", i) for i in range(1, 5)], "video string, track_id int")
    got = {r.track_id: (r.barcode, r.barcode_source) for r in cascade.resolve_barcodes(keys, attempts, inline, fallback).collect()}
    assert got == {1: (good, "zxing"), 2: (other, "vlm_inline"), 3: (other, "vlm_fallback"), 4: ("", "none")}
    skipped = {r.track_id: r.barcode_source for r in cascade.resolve_barcodes(keys, attempts, inline, fallback, skip_fallback=True).collect()}
    assert skipped[3] == skipped[4] == "skipped_fallback"


def test_assembly_and_summary(spark):
    picked = spark.createDataFrame([("v", 1, "/d/v.mp4", 10), ("v", 2, "/d/v.mp4", 20)], "video string, track_id int, path string, ts_ms int")
    reads = spark.createDataFrame([("v", 1, 'x {"color": "red", "price1_qr": "9.00", "product_name": " Сыр "}')], "video string, track_id int, raw string")
    codes = spark.createDataFrame([("v", 1, ""), ("v", 2, "")], "video string, track_id int, barcode string")
    qr = spark.createDataFrame([("v", 1, 0, "cv2", None), ("v", 1, 1, "zxing", "b=4670025474665|p1=5")], "video string, track_id int, cand_idx int, source string, payload string")
    first = cascade.first_payload(qr)
    out = cascade.assemble(picked, reads, codes, first, archetypes(spark))
    rows = {r.track_id: r for r in out.collect()}
    r = rows[1]
    assert (r.product_name, r.price1_qr, r.barcode, r.qr_code_barcode, r.code, r.price_card) == ("Сыр", "5.00", "4670025474665", "4670025474665", "нет", "")
    assert rows[2].color == "" and rows[2].code == ""
    s = summary.run_summary(out.withColumn("barcode_source", F.lit("vlm_inline")))
    assert s.first().barcode_vlm_inline == 2 and s.first().qr_decoded == 1
    assert summary.three_sources(s).columns == ["rows", "barcode_zxing", "barcode_vlm_fallback", "barcode_none", "qr_decoded"]
    assert cascade.detect_only(picked, "path").columns == COLUMNS


def test_label_sets(spark):
    truth = spark.createDataFrame([("v", "100", "1,5", "2", "30", "40"), ("v", "x", "1", "2", "3", "4"), ("v", "350", "1", "2", "1", "4"), ("w", "0", "0", "0", "5", "5")], "video string, frame_timestamp string, x_min string, y_min string, x_max string, y_max string")
    rows = datasets.parse_truth(truth)
    assert rows.count() == 3
    t = datasets.with_offsets(rows, ["video"])
    assert sorted((r.video, r.target_ms, r.ts_ms) for r in t.collect()) == [("v", 100, 350), ("v", 350, 350), ("v", 600, 350), ("w", 0, 0)]
    labels = datasets.label_rows(t, "video", F.lit(100), F.lit(100))
    files = {r.stem: r.content for r in datasets.label_files(labels).collect()}
    assert files == {"w_t0000000": "0 0.025000 0.025000 0.050000 0.050000"}
    assert "train: images/train" in datasets.manifest("/d", ["tag"])
    crops = spark.createDataFrame([(200, 80.0), (100, 80.0), (200, 20.0)], "height int, sharpness double")
    assert datasets.good_crops(crops).count() == 1


def test_a_whole_run(spark):
    """Detections to CSV lines: best frames, codes, a payload of a candidate frame, names by the gallery; tracks without answers."""
    from tagloom.operators import run
    from tagloom.sources import tables

    good, other = "4670025474665", "4600000000008"
    frames = [("v", 1, "/d/v.mp4", s, s * 40, 1.0, 2.0, 30.5, 40.0, 100.0, float(s % 3), s == 0) for s in range(6)] + [("v", 2, "/d/v.mp4", 9, 360, 0.0, 0.0, 5.0, 5.0, 25.0, 1.0, False)]
    detections = spark.createDataFrame(frames, "video string, track_id int, path string, seq int, ts_ms int, x1 double, y1 double, x2 double, y2 double, area double, sharpness double, touches_edge boolean")
    decoded = spark.createDataFrame([("v", 1, 3, 0, "12"), ("v", 1, 4, 2, good)], "video string, track_id int, seq int, variant_idx int, text string")
    reads = spark.createDataFrame([("v", 1, 'x {"color": "red", "product_name": "Малоко отборное", "price_default": "12.5", "barcode": "' + other + '"}')], "video string, track_id int, raw string")
    payloads = spark.createDataFrame([("v", 1, 0, "p1=5", "zxing"), ("v", 1, 1, "p1=7", "zxing")], "video string, track_id int, seq int, payload string, source string")
    gallery = spark.createDataFrame([(0, "Молоко отборное"), (1, "Сыр")], "ord int, entry string")
    out = run.resolve_run(detections, decoded, reads, None, payloads, gallery)
    rows = {r.track_id: r for r in out.collect()}
    r = rows[1]
    assert (r.seq, r.product_name, r.barcode, r.barcode_source, r.price1_qr, r.qr_source) == (2, "Молоко отборное", good, "zxing", "5.00", "zxing")
    assert (rows[2].seq, rows[2].product_name, rows[2].barcode, rows[2].barcode_source, rows[2].qr_source) == (9, "", "", "none", None)
    lines = sorted(r.line for r in tables.format_rows(run.record_run(out)).collect())
    assert lines[1] == 'd/v.mp4,Молоко отборное,"12,50",,нет,4670025474665,,,нет,нет,нет,red,,80,"1,0","2,0","30,5","40,0",,5.00,,нет,,нет,нет,нет,нет,нет,нет'
    plain = run.resolve_run(detections, decoded, reads, skip_fallback=True)
    assert {r.track_id: (r.product_name, r.barcode_source, r.price1_qr) for r in plain.collect()} == {1: ("Малоко отборное", "zxing", ""), 2: ("", "skipped_fallback", "")}


def test_evaluation_of_a_run(spark):
    from tagloom.operators import run

    def record(line, **cells):
        return ("v", line, *[cells.get(c, "") for c in COLUMNS])

    schema = "video string, line int, " + ", ".join(f"{c} string" for c in COLUMNS)
    place = {"frame_timestamp": "1000", "x_min": "0", "y_min": "0", "x_max": "10", "y_max": "10,0"}
    truth = spark.createDataFrame([record(1, barcode="4670025474665", color="red", price_card="2.00"), record(2, **place, color="blue"), record(3, color="white")], schema)
    pred = spark.createDataFrame([record(1, barcode="4670025474666", color="Red", price_card="2,00"), record(2, **(place | {"frame_timestamp": "2500", "x_min": "1"}), color="red"), record(3, **(place | {"frame_timestamp": "late"})), record(4, **(place | {"frame_timestamp": "9000"}))], schema)
    assert [(r.p_ord, r.g_ord, r.rule) for r in run.match_run(pred, truth, ["video"]).orderBy("p_ord").collect()] == [(1, 1, 1), (2, 2, 2)]
    r = run.evaluate_run(pred, truth, ["video"]).first()
    assert (r.n_pred, r.n_gt, r.matched, r.precision, r.kpi_pass_rate, r.acc_color, r.acc_barcode, r.acc_price_card, r.acc_product_name) == (4, 3, 2, 0.5, 0.5, 0.5, 1.0, 1.0, 0.0)
    assert r.recall == pytest.approx(2 / 3)
    none = run.evaluate_run(pred.limit(0), truth.limit(0), ["video"]).first()
    assert (none.matched, none.recall, none.precision, none.kpi_pass_rate) == (0, 0.0, 0.0, 0.0)


def test_whole_tracks_over_shards(spark):
    """One track over five shards has one number; of rivals at a border the one of most overlap goes on; ends without a start."""
    from tagloom.operators import shards

    def row(video, shard, track, x, begins=0, ends=10_000, x_end=None):
        x_end = x if x_end is None else x_end
        return (video, shard, track, shard * 10_000 + begins, float(x), 0.0, x + 10.0, 10.0, shard * 10_000 + ends, float(x_end), 0.0, x_end + 10.0, 10.0)

    rows = [row("v", s, 7 + s, 100 + s, x_end=101 + s) for s in range(5)]
    rows += [row("v", 0, 1, 0), row("v", 0, 2, 2), row("v", 1, 1, 3), row("v", 1, 2, 0, begins=100)]  # 0.1 and 0.2 both near 1.1 and 1.2
    rows += [row("v", 1, 99, 101, begins=6000), row("w", 1, 1, 0), row("w", 3, 1, 0), row(None, 0, 1, 0)]
    schema = "video string, shard int, track int, " + ", ".join(f"{c} {'long' if c.endswith('ts') else 'double'}" for c in (*shards.START, *shards.END))
    df = spark.createDataFrame(rows, schema).repartition(3)
    links = {(r.video, r.shard, r.track): r.next for r in shards.border_links(df).collect()}
    assert links == {**{("v", s, 7 + s): 8 + s for s in range(4)}, ("v", 0, 1): 2, ("v", 0, 2): 1}
    whole = {(r.video, r.shard, r.track): r.whole for r in shards.whole_tracks(df).collect()}
    assert len(whole) == 12 and len({whole["v", s, 7 + s] for s in range(5)}) == 1
    assert whole["v", 0, 1] == whole["v", 1, 2] == 1 and whole["v", 0, 2] == whole["v", 1, 1] == 2
    assert sorted(set(whole.values())) == list(range(1, 7))
    assert shards.whole_tracks(df.limit(0)).collect() == []
