import datetime
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartledger.functions import pricing as P
from cartledger.functions.similarity import lcs_lengths
from cartledger.functions.sizes import parse_size, unit_price
from cartledger.functions.taxonomy import coarse_category, compatible
from cartledger.functions.text import display_name, normalize_name, unescape_all, unescape_basic


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).orderBy("i").select(expr).collect()]


def test_parse_size(spark):
    cases = [
        ("Net 750 ML bottle", "fl_oz", 750 * 0.033814), ("3 quarts", "fl_oz", 96.0), ("3/4 pint", "fl_oz", 12.0),
        ("2 1/4 lbs net", "oz", 36.0), ("0.5 KG", "oz", 0.5 * 35.274), ("7/0 gram", "oz", None),
        ("box of 48 cnt", "ct", 48.0), ("4 pks of 9 oz", "ct", 4.0), ("sold per pound", "oz", 16.0),
        ("per jar, 2 pints", "fl_oz", 32.0), ("a dozen roses", None, None), ("", None, None), (None, None, None),
    ]
    got = column(spark, [(i, c[0]) for i, c in enumerate(cases)], "i int, t string", parse_size(F.col("t")))
    for (text, base, qty), size in zip(cases, got):
        assert (size and size["base_unit"]) == base, text
        assert (size and size["base_qty"]) == qty, text


def test_unit_price(spark):
    rows = [(0, 6.4, "2 qt"), (1, 7.0, "3 lbs"), (2, 5.5, "one tray"), (3, None, "8 each"), (4, 2.0, "0 ct"), (5, 0.9, "40 ct")]
    got = column(spark, rows, "i int, p double, t string", unit_price(F.col("p"), F.col("t")))
    assert [tuple(g) for g in got] == [
        (0.1, "$/fl_oz"), (0.1458, "$/oz"), (None, None), (None, None), (None, None), (0.0225, "$/ct")
    ]


def test_names(spark):
    rows = [(0, "Brightfield™ Oat  Flakes (bulk)"), (1, "Crunchy Rusks, 250 g"), (2, None), (3, "!!")]
    got = column(spark, rows, "i int, t string", F.struct(normalize_name(F.col("t")), display_name(F.col("t"))))
    assert [g[0] for g in got] == ["brightfield oat flakes", "crunchy rusks", "", ""]
    assert got[0][1] == "Brightfield Oat  Flakes (bulk)"


def test_unescape(spark):
    rows = [(0, "&quot;a&quot; &amp;lt; &#39;b&#39; &eacute;")]
    assert column(spark, rows, "i int, t string", unescape_all(F.col("t"))) == ["\"a\" &lt; 'b' é"]
    assert column(spark, rows, "i int, t string", unescape_basic(F.col("t"))) == ["\"a\" &lt; 'b' &eacute;"]


def test_coarse_category(spark):
    cases = [
        (None, "Turkey Jerky Bites", "snack"), (None, "Pork Ribs", "protein"), (None, "Lamb Gravy", "pantry"),
        (None, "Lemon Muffins", "pantry"), (None, "Seedless Limes", "produce"), (None, "Mango Sorbet", "frozen"),
        (None, "Aged Gouda Wedge", "dairy"), (None, "Oat Milk Shampoo", "household"), (None, "Tofu Noodles", "pantry"),
        ("Candy Aisle", "Salmon Shaped Gummies", "snack"), ("Poultry", "Family Value Tray", "protein"),
        ("FROZEN meals", "Beef Lasagna", "frozen"), ("Coffee bar", "Cream", "pantry"), ("Baby", "Pears", "household"),
        ("Seasonal", "Kale Bunch", "produce"), (None, "Phone Charger", None), ("", "", None), (None, None, None),
    ]
    rows = [(i, h, n) for i, (h, n, _) in enumerate(cases)]
    got = column(spark, rows, "i int, h string, n string", coarse_category(F.col("h"), F.col("n")))
    assert got == [c for _, _, c in cases]


def test_guard_is_lenient_about_unknown(spark):
    rows = [(0, "a", "a"), (1, "a", "b"), (2, None, "b"), (3, None, None)]
    got = column(spark, rows, "i int, a string, b string", compatible(F.col("a"), F.col("b")))
    assert got == [True, False, True, True]


def test_prices(spark):
    day = datetime.date
    rows = [(i, day(2026, 7, 5 + i)) for i in range(7)]  # Sunday to Saturday
    weeks = column(spark, rows, "i int, d date", P.ad_week(F.col("d")))
    assert weeks == [day(2026, 7, 1)] * 3 + [day(2026, 7, 8)] * 4
    # ties go to even: 12.5% -> 12, 37.5% -> 38
    rows = [(0, 8.0, 7.0), (1, 8.0, 5.0), (2, 0.0, 1.0), (3, None, 1.0)]
    assert column(spark, rows, "i int, r double, p double", P.discount_pct(F.col("r"), F.col("p"))) == [12, 38, None, None]
    rows = [(0, 4.0, 3.0), (1, 4.0, 5.0), (2, None, 3.0), (3, 4.0, 0.0), (4, 4.0, None)]
    lower = column(spark, rows, "i int, r double, s double", P.promo_when_lower(F.col("r"), F.col("s")))
    assert lower == [True, False, True, False, False]
    positive = column(spark, rows, "i int, r double, s double", P.promo_when_positive(F.col("r"), F.col("s")))
    assert positive == [True, True, True, False, False]


def test_clamp_verdict(spark):
    rows = [(0, "match", 1.7, "x" * 900), (1, None, None, None), (2, "no_match", -1.0, "r")]
    got = column(spark, rows, "i int, v string, c double, r string",
                 P.clamp_verdict(F.col("v"), F.col("c"), F.col("r")))
    assert [(g["verdict"], g["confidence"], len(g["reason"])) for g in got] == [
        ("match", 1.0, 500), ("no_match", 0.0, 0), ("no_match", 0.0, 1)
    ]


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", max_size=90), st.text("ab c", max_size=90)), max_size=12))
def test_lcs_equals_table(pairs):
    got = lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [lcs_table(a, b) for a, b in pairs]


def test_lcs_word_boundary():
    r = random.Random(5)
    words = ["".join(r.choice("abc") for _ in range(n)) for n in (63, 64, 65, 66)]
    a, b = zip(*[(x, y) for x in words for y in words])
    assert lcs_lengths(list(a), list(b)).tolist() == [lcs_table(x, y) for x, y in zip(a, b)]
