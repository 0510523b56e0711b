import pytest

from weftline.functions.quantity import standard_size

CASES = [
    ("Lumo Serum 45ml", 45, "ml", 1, (45.0, "volume", 1, "ok")), ("Lumo Powder 12g", 12, "g", None, (12.0, "mass", 1, "ok")), ("Lens [1 Pair]", 1, "Pairs", 1, (2.0, "count", 1, "ok")), ("Cotton 80 Pcs", 80, "pcs", 80, (80.0, "count", 1, "ok")),
    ("Lumo Mask [20ml x 4pcs]", 20, "ml", 4, (80.0, "volume", 4, "ok")), ("Lumo Dye [3pcs x 10g] #Black", 10, "g", 3, (30.0, "mass", 3, "ok")), ("Tissue [150 Sheets x 6pcs]", 150, "Sheets", 6, (900.0, "count", 6, "ok")), ("Lotion [500ml x 2pcs]", 1000, "ml", 2, (1000.0, "volume", 2, "ok")),
    ("Balm 2 x 30ml", 30, "ml", None, (60.0, "volume", 2, "ok")), ("Balm 25ml x 3", 25, "ml", None, (75.0, "volume", 3, "ok")), ("Wash 40ml + Rinse 40g", 40, "ml", None, (80.0, "mixed", None, "bundle_summed")), ("Duo (380ml+380ml.)", 760, "ml", 2, (760.0, "volume", None, "bundle_summed")),
    ("Stick 5g #01 Light + Stick 5g #00 Peach", 5, "g", 2, (10.0, "mass", None, "bundle_summed")), ("Lotion 450ml + Free! Foam [30ml x 2pcs]", 450, "ml", None, (450.0, "volume", 1, "ok")), ("Cushion 2 ROSE", 15, "g", 2, (15.0, "mass", 1, "pieces_unverified")), ("Pad 200g [60 Pads]", 200, "g", 60, (200.0, "mass", 1, "ok")),
    ("Lip Duo Set", 2, "g", 1, (2.0, "mass", 1, "bundle_unresolved")), ("Floss 50m", 50, "m", None, (None, None, None, "not_a_quantity")), ("Thing", None, None, None, (None, None, None, "no_size")), ("Thing", 0, "ml", None, (None, None, None, "no_size")), ("Pen [0.1g x 0.35ml]", 0.1, "g", None, (None, None, None, "ambiguous_x")),
    (None, 10, "ml", None, (10.0, "volume", 1, "ok")), ("x" * 50_000, 10, "fl. oz", None, (295.735, "volume", 1, "ok")),
]


@pytest.mark.parametrize("name, size, unit, pieces, want", CASES)
def test_sizes(name, size, unit, pieces, want):
    assert tuple(standard_size(name, size, unit, pieces)) == pytest.approx(want)
