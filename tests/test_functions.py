import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tagloom.functions import cells, codes, geometry, naming, numbers, payload, text
from tagloom.schema import FIELDS, PAYLOAD_KEYS, REQUIRED


def ask(spark, pairs, fn, kinds="string"):
    """fn over columns a, b, ... for each row of arguments."""
    rows = [(i, *(p if isinstance(p, tuple) else (p,))) for i, p in enumerate(pairs)]
    names = "abcdef"[: len(rows[0]) - 1]
    kinds = [kinds] * len(names) if isinstance(kinds, str) else kinds
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return [r.v for r in df.select("i", fn(*[F.col(n) for n in names]).alias("v")).orderBy("i").collect()]


def test_prices(spark):
    got = ask(spark, ["Цена 129.99 руб", "129,99", "129 99", "12999", "129.99 и 252.63", "no price", None, "1"], text.find_prices)
    assert got == [[129.99]] * 4 + [[129.99, 252.63], [], [], []]


def test_barcode_match(spark):
    g = "4670025474665"
    pairs = [(g, "4670025474675"), (g, "4670025474676"), (g, "4670025474778"), (g, "670025474665"), (g, ""), (None, g), (g, g)]
    assert ask(spark, pairs, codes.barcode_match) == [True, True, False, True, False, False, True]


def test_ean13(spark):
    given = ["4670025474665", "4670025474666", "46700254746", "46700254746650", "467002547466x", None, "", "4670025474665\n"]
    assert ask(spark, given, codes.ean13_valid) == [True] + [False] * 7


def test_fuzzy_contains(spark):
    hay = "сыр российский молодой 45% 200 г брусок"
    pairs = [(hay, hay), (hay, "сыр росийский молодой брусок"), ("молоко отборное", "хлеб ржаной"), (hay, ""), ("", hay)]
    a, b, c, d, e = ask(spark, pairs, text.fuzzy_contains)
    assert a >= 0.99 and b >= 0.7 and c < 0.3 and d == 0 and e == 0


def test_words_keep_letters_of_all_scripts(spark):
    assert ask(spark, ["Сыр32, «А-Б»  x_y!", None], text.words) == [["сыр32", "аб", "x_y"], []]
    assert ask(spark, ["  a \n", None], text.strip) == ["a", ""]
    assert ask(spark, ["  Молоко \n 3,2% "], text.squeeze) == ["молоко 3,2%"]


def test_type_patterns(spark):
    values = ["12", "-3", "12\n", "1,5", "1.5", "-15%", "15%", "01.02.2024 10:20", "1.2.24 1:2"]
    assert ask(spark, values, codes.is_int) == [True, True] + [False] * 7
    assert ask(spark, values, codes.is_comma_decimal) == [False] * 3 + [True] + [False] * 5
    assert ask(spark, values, codes.is_dot_decimal) == [False] * 4 + [True] + [False] * 4
    assert ask(spark, values, codes.is_percent_off) == [False] * 5 + [True] + [False] * 3
    assert ask(spark, values, codes.is_print_time) == [False] * 7 + [True, False]


def test_numbers(spark):
    assert ask(spark, ["2063,1", " 1.5 ", "1_000", "12d", "", None, "-2", "1e3"], numbers.to_double) == [2063.1, 1.5, None, None, None, None, -2.0, 1000.0]
    assert ask(spark, ["x", "3,5"], numbers.coordinate) == [0.0, 3.5]
    assert ask(spark, ["6595.9", "bad"], numbers.milliseconds) == [6595, None]
    assert ask(spark, ["252,63", "129", "129.9", "129.9 руб", "hello"], numbers.price_text) == ["252.63", "129.00", "129.90", "129.90", "hello"]
    rng = random.Random(1)
    values = [0.125, 2.5, 0.25, 2.675, 0.375, 0.005, 0.015, 1.005, 0.995, 9.995, 99.995, 0.5, 1.5, -0.001, -0.0, 0.0, -2.675, 1e15 + 0.125, 4503599627370497.5, 2.0**53 + 2, 1e18, 5e-324, 0.004999999999999999]
    values += [rng.randrange(-(10**6), 10**6) / 1000 for _ in range(400)] + [rng.random() * 10 ** rng.randrange(-8, 15) for _ in range(400)] + [rng.randrange(10**5) / 64 for _ in range(200)]
    for places in (1, 2, 3):
        assert ask(spark, [*values, None], lambda x: numbers.fixed(x, places), "double") == [*(f"{v:.{places}f}" for v in values), None]


def test_cells(spark):
    one = lambda field, *v, **k: ask(spark, list(v), lambda x: cells.cell(field, x, **k))
    assert one("price_card", "129.99", "нет", "", None, "1 299,99") == ['"129,99"', "нет", "", "", '"1 299,99"']
    assert one("price_card", "1 299,99", compat=True) == ["1 299,99"]
    assert one("price1_qr", "129,99", "x") == ["129.99", "x"]
    assert one("x_min", "2063.123", "bad") == ['"2063,1"', "bad"]
    assert one("frame_timestamp", "6595.0", "6595", "x") == ["6595", "6595", "x"]
    assert one("product_name", "a, b", 'say "x"', "plain", "two\nlines") == ['"a, b"', '"say ""x"""', "plain", '"two\nlines"']
    assert one("product_name", "two\nlines", compat=True) == ["two\nlines"]
    assert ask(spark, ["a,b", '"a,b"', "ab"], cells.final_cell) == ['"a,b"', '"a,b"', "ab"]


def test_payload(spark):
    cases = {
        "barcode=4670025474665|price1=252.63|price2=239.99|price4=129.99|actionPrice=129.99|actionCode=PROMO5": {"qr_code_barcode": "4670025474665", "price1_qr": "252.63", "price2_qr": "239.99", "price4_qr": "129.99", "action_price_qr": "129.99", "action_code_qr": "PROMO5"},
        "b=4670025474665|p1=10|wL1C=3|wL1P=99.00|wL2C=10|wL2P=89.00": {"qr_code_barcode": "4670025474665", "price1_qr": "10.00", "wholesale_level_1_count": "3", "wholesale_level_1_price": "99.00", "wholesale_level_2_count": "10", "wholesale_level_2_price": "89.00"},
        "4670025474665": {"qr_code_barcode": "4670025474665"},
        "код 4670025474665": {"qr_code_barcode": "4670025474665"},
        "hello": {"_extra": "hello"},
        "": {},
        None: {},
        "b%3D4670025474665%7Cp1%3D5": {"qr_code_barcode": "4670025474665", "price1_qr": "5.00"},
        "barcode:4670025474665;price1:252,63": {"qr_code_barcode": "4670025474665", "price1_qr": "252.63"},
        "b=1|zz=2|free": {"qr_code_barcode": "1", "_extra": "zz=2 | free"},
        "p1=1|P1=2.5": {"price1_qr": "2.50"},
        "aC=a+b%zz": {"action_code_qr": "a+b%zz"},
    }
    assert ask(spark, list(cases), payload.parse_payload) == list(cases.values())
    assert len({n.lower() for names in PAYLOAD_KEYS.values() for n in names}) == 22


def test_json_in_prose(spark):
    got = ask(spark, ['{"a": "1"}', 'text {"a": "1",\n"b": null} end', "{broken", "", None, "[1]", '{"a": [1, 2], "c": true}'], payload.json_in)
    assert got == [{"a": "1"}, {"a": "1", "b": None}, {}, {}, {}, {}, {"a": "[1,2]", "c": "true"}]
    assert ask(spark, ['{"a": " x\\n", "b": null}'], lambda r: F.array(*[payload.field_of(payload.json_in(r), k) for k in "abc"])) == [["x", "", ""]]
    texts = ["１²", "ｂ＝４６７０", "abc", "", "ﬁ № ①", "e\u0301", "가", "｜；＆", "\u3000x"]
    assert ask(spark, [*texts, None], payload.nfkc) == [*(unicodedata.normalize("NFKC", t) for t in texts), None]


def test_truth_of_records(spark):
    rows = ['{"image": "i", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "{\\"color\\": \\"red\\"}"}]}', '{"messages": [{"role": "a", "content": [{"type": "text", "text": "{\\"color\\": \\"blue\\"}"}]}]}']
    assert ask(spark, rows, payload.truth_of) == [{"color": "red"}, {"color": "blue"}]


def test_boxes(spark):
    four = ["double"] * 4
    box = lambda *c: tuple(c)
    assert ask(spark, [(0.0, 0.0, 2.0, 2.0), (5.0, 5.0, 6.0, 6.0), (1.0, 0.0, 1.0, 2.0)], lambda a, b, c, d: geometry.iou(box(a, b, c, d), tuple(map(F.lit, (1.0, 1.0, 3.0, 3.0)))), four) == [pytest.approx(1 / 7), 0.0, 0.0]
    label = ask(spark, [(100.0, 200.0, 300.0, 400.0), (-10.0, 2000.0, 50.0, 3000.0)], lambda *c: geometry.to_label(c, F.lit(3840), F.lit(2160)), four)
    assert tuple(label[0]) == pytest.approx((200 / 3840, 300 / 2160, 200 / 3840, 200 / 2160))
    assert tuple(label[1]) == pytest.approx((25 / 3840, 2080 / 2160, 50 / 3840, 160 / 2160))
    key = ask(spark, [("2063,1", "1929,8", "2296,6", "2126,1"), ("", "", "", "")], lambda *c: geometry.box_key(c))
    assert key == ["2063.1_1929.8_2296.6_2126.1", "___"]
    medium = ask(spark, [(480.0, 480.0, 520.0, 520.0)], lambda *c: geometry.distorted(c, F.lit(1000), F.lit(1000), "medium"), four)[0]
    assert abs((medium.x1 + medium.x2) / 2 - 500) < 20 and abs((medium.y1 + medium.y2) / 2 - 500) < 20
    strong = ask(spark, [(10.0, 10.0, 60.0, 60.0)], lambda *c: geometry.distorted(c, F.lit(1000), F.lit(1000), "strong"), four)[0]
    assert (strong.x1 + strong.x2) / 2 > 20
    pad = ask(spark, [(10.0, 10.0, 50.0, 30.0), (200.0, 10.0, 210.0, 30.0)], lambda *c: geometry.padded(c, F.lit(100), F.lit(100)), four)
    assert tuple(pad[0]) == (0, 8, 60, 32) and pad[1] is None
    assert ask(spark, [(2.0, 10.0, 50.0, 30.0), (3.0, 3.0, 97.0, 97.0)], lambda *c: geometry.touches_edge(c, F.lit(100), F.lit(100)), four) == [True, False]
    assert tuple(ask(spark, [(1920, 1080)], lambda w, h: geometry.resized(w, h, 960), ["int"] * 2)[0]) == (960, 540)
    back = ask(spark, [(0.5, 0.5, 0.2, 0.4)], lambda *c: F.array(*geometry.from_label(*c, F.lit(100), F.lit(50))), four)[0]
    assert back == pytest.approx([40, 15, 60, 35])
    assert math.isclose(ask(spark, [(10.0, 20.0, 30.0, 40.0)], lambda *c: geometry.percent_to_label(*c)["cy"], four)[0], 0.4)


def test_names(spark):
    assert ask(spark, ["/a/b/c.mp4", "c.mp4"], naming.tail_name) == ["b/c.mp4", "c.mp4"]
    assert ask(spark, ["http://h/x/y.jpg?d=1"], lambda u: naming.flat_name(naming.image_part(u))) == ["x__y.jpg"]
    assert ask(spark, ["t0005000.jpg", "bad.jpg"], naming.frame_time) == [5000, 0]
    assert ask(spark, [("v", 250)], naming.frame_stem, ["string", "int"]) == ["v_t0000250"]
    assert ask(spark, [7], naming.track_stem, "int") == ["trk_0007"]
    assert ask(spark, ["/r/a/b", "/s/b"], lambda p: naming.relative_to(p, "/r")) == ["a/b", "/s/b"]
    assert ask(spark, ["a/b", "/s/b"], lambda p: naming.resolved(p, "/r")) == ["/r/a/b", "/s/b"]
    assert ask(spark, ["1\n2\n3"], lambda s: naming.last_lines(s, 2)) == ["2\n3"]
    got = ask(spark, [(5, 10, 1), (10, 10, 2), (0, 0, 1)], naming.progress, ["int"] * 3)
    assert got == pytest.approx([0.25, 0.95, 0.0])
    logs = ["[detect v] 5/10 (50%)", "[detect v] 5/10 (50%)\n[infer v] 1/2 ( 50%) eta", "none", "[infer v] 2/2 (100%)"]
    assert ask(spark, logs, naming.log_progress) == pytest.approx([0.25, 0.725, 0.0, 0.95])
    assert naming.truthy(" Yes ") and not naming.truthy(None)


def test_dimensions():
    assert len(FIELDS) == 23 and set(REQUIRED) == {"red", "yellow", "green", "white", "purple", "orange", "blue"}
    assert all(set(v) <= set(FIELDS) for v in REQUIRED.values())


def test_name_similarity(spark):
    assert ask(spark, [("abcd", "abcx"), ("", "x"), ("a", "a"), ("ab", "abcd")], text.name_similarity) == [0.75, 0.0, 1.0, 0.5]


def test_fixed_against_the_exact_binary_value(spark):
    from decimal import ROUND_HALF_EVEN, Decimal

    rng = random.Random(12)
    xs = [0.0, -0.0, 0.125, -0.375, 2.675, 1.005, 0.05, -0.04, 1e-300, 999999999.9995, 1e9 - 0.005, 1e9 + 0.5, 1e15 + 0.125, 2.0**62, 1e300, 0.995, 99.9999, 123456789.0005]
    xs += [rng.choice([1, -1]) * round(rng.random() * 10 ** rng.randrange(10), rng.randrange(5)) for _ in range(400)] + [rng.randrange(10**6) / 8 for _ in range(200)]
    for places in (1, 2, 3):
        got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(numbers.fixed(F.col("x"), places)).collect()]
        want = [format(Decimal(x).quantize(Decimal(10) ** -places, ROUND_HALF_EVEN), "f") if abs(x) < 2.0**62 else None for x in xs]
        assert [g for g, w in zip(got, want) if w is not None] == [w for w in want if w is not None]
    assert spark.range(1).select(numbers.fixed(F.lit(None).cast("double"), 2)).first()[0] is None
