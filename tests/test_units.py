import random

from weftline.functions.sizes import content, folded, stated, unit_of
from weftline.operators import units


def test_contents_of_names():
    cases = {
        "Aqua Serum 3 x 50 ml": ("ml", 50, 3), "Twin Pack 2.82oz cream": ("g", 80, 2), "(75ml (แพ็ค 5)) serum": ("ml", 75, 5), "Toner 8.45 FL OZ": ("ml", 250, 1), "60 gx3": ("g", 60, 3), "Mask 5 คู่": ("pcs", 10, 1),
        "cushion #12 gold 15กรัม": ("g", 15, 1), "SPF 50 PA+++ 60มล.": ("ml", 60, 1), "Gel 0.45 L + Free mini 5 ml": ("ml", 450, 1), "Gel แถมฟรี ตัวอย่าง 3ml": None, "lotion 24H 3in1": None, "wipes 2 dozen": ("pcs", 24, 1), "ＳＥＲＵＭ １００ ＭＬ": ("ml", 100, 1), "soap 80 ɡm": ("g", 80, 1),
    }
    for name, want in cases.items():
        got = content(name)
        assert (got and (got[0], round(got[1]), got[2])) == want, name


def test_labels():
    assert stated(folded("3 x 450 ml")) == ("ml", 1350.0, False) and stated(folded("x 36pcs")) == ("pcs", 36.0, True) and stated("ml") is None
    assert unit_of("fl.oz.") == ("ml", 29.5735) and unit_of("oz.") == ("g", 28.3495) and unit_of("furlong") is None


SCHEMA = "id long, s double, l string, t string, c string, p double, u double, size string, a string"


def convert(df):
    return units.to_common_units(df, "id", "s", "l", "t", "c", "p", "u")


def test_rows(spark):
    data = [
        (1, 5.0, "48 pcs", "wipes", "B", 567.0, 2.3625), (2, 0.75, "ลิตร", "gel", "B", 335.0, 446.6667), (3, None, "ML", "cream 3.38 fl oz", "B", 300.0, 3.0), (4, float("nan"), None, "nothing told", "B", None, None),
        (5, -3.0, "ml", "x", "B", 1.0, 1.0), (6, 50.0, "ml", None, None, None, 2.0), (6, 50.0, "ml", None, None, None, 2.0), (7, 2.03, "fl oz", "foam 60ml", "B", 100.0, 49.26), (8, 10.0, "ml", "a" * 200_000, "B", 0.0, 1.0),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in data], SCHEMA)
    got = {(r.id, r.base_unit, r.base_size, r.price_base) for r in convert(df).distinct().collect()}
    assert got == {(1, "pcs", 240, 1), (2, "ml", 750, 1000), (3, "ml", 100, 1), (6, "ml", 50, 0), (7, "ml", 60, 30), (8, "ml", 10, 0)}


def test_empty(spark):
    assert convert(spark.createDataFrame([], SCHEMA)).count() == 0


def test_missing_units_by_mixture(spark):
    rnd = random.Random(1)
    known = [(i, float(rnd.choice([100, 150, 200, 250])), "ml", "gel", "B", 1.0, 1.0, "", "") for i in range(400)]
    lost = [(1000 + i, rnd.choice([0.1, 0.15, 0.2, 0.25]), None, "gel", "B", 1.0, 1.0, "", "") for i in range(60)]
    near = [(2000, 200.0, None, "gel", "B", 1.0, 1.0, "", "")]
    got = {r.id: r for r in convert(spark.createDataFrame(known + lost + near, SCHEMA)).where("way = 'mixture'").collect()}
    assert len(got) == 61 and all(r.base_unit == "ml" and 90 <= r.base_size <= 260 for r in got.values())
    assert all(0 < r.posterior <= 1 and r.uncertain == (r.posterior < 0.95) for r in got.values())
