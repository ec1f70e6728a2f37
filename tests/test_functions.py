import datetime as dt

import pytest
from pyspark.sql import functions as F

from plotwise.functions import dates, display, fixed, numbers, text


def test_parse_price(one):
    cases = [
        ("3.5 ล้าน", 3_500_000.0), ("35ล้านบาท", 35_000_000.0), ("8 แสน", 800_000.0),
        ("3,500,000 บาท", 3_500_000.0), ("1.2.3 ล้าน", None), ("5d", None), ("0 ล้าน", 0.0), ("0", None),
        ("-5", None), ("ล้าน", None), (None, None), (" 1000 ", 1000.0), ("๓.๕ ล้าน", 3_500_000.0),
        ("1 ล้าน 5 แสน", 1_000_000.0), ("5.0E7", 50_000_000.0), (", ล้าน", None),
    ]
    got = one(lambda p: numbers.parse_price(p, F.lit("Baania"), F.lit("sqw")), *[c[0] for c in cases], schema="p string")
    assert got == [c[1] for c in cases]


def test_parse_price_of_usd_feed(one):
    got = one(numbers.parse_price, ("100000", "HipFlat", "sqm_split"), ("600000", "HipFlat", "sqm_split_thb"),
              ("2 ล้าน", "HipFlat", "sqm_split"), ("100", None, None), schema="p string, s string, u string")
    assert got == [3_500_000.0, 600_000.0, 2_000_000.0, 100.0]
    assert one(numbers.cap_price, 5e8, 5e8 + 1, schema="p double") == [5e8, None]


def test_to_sqm(one):
    rows = [(None, "sqm_split", 12.0, 5.0, 10.0), (80.0, "sqm_split", None, 1.0, 1.0), (80.0, "sqm_split", 0.0, 0.0, 0.0),
            (5.0, "sqw", None, None, None), (50.0, "sqm", None, None, None), (-5.0, "sqw", None, None, None),
            (None, "sqm", None, None, None), (10.0, "sqm_split_thb", 0.5, 0.0, 0.0), (0.0, "sqm_split", None, None, None)]
    got = one(numbers.to_sqm, *rows, schema="a double, u string, r double, n double, w double")
    assert got == [17240.0, 80.0, 80.0, 20.0, 50.0, None, None, 800.0, None]
    assert one(numbers.cap_area, 20000.0, 20004.0, schema="a double") == [20000.0, None]


def test_to_number(one):
    texts = ["5", " 5.5 ", "5d", "1e3", "-2", "+.5", "N/A", "", "1,000", "nan", None, "\t7\t", "๑๒"]
    assert one(numbers.to_number, *texts, schema="t string") == [
        5.0, 5.5, None, 1000.0, -2.0, 0.5, None, None, None, None, None, 7.0, None]


def test_bedrooms(one):
    assert one(numbers.bedroom_number, "studio", "3+1", "N/A", "2", "2.0", None, schema="b string") == [
        0.0, 4.0, None, 2.0, 2.0, None]
    types = ["Condo", "House", "Townhouse", "Townhome", "Land", "คอนโด", "asdf", None]
    got = one(lambda t: numbers.default_bedrooms(F.lit(None).cast("double"), t), *types, schema="t string")
    assert got == [1.0, 3.0, 3.0, 2.0, 0.0, 1.0, None, None]


def test_test_prices(one):
    rows = [("0.0", 0.0, False), ("0", 0.0, True), ("0.0", 0.0, True), (" 1 ", 1.0, True), ("2", 2.0, True), (None, None, False)]
    assert one(numbers.is_test_price, *rows, schema="r string, n double, t boolean") == [
        True, True, False, True, False, False]


@pytest.mark.parametrize("raw, day", [
    ("2024-03-05", dt.date(2024, 3, 5)), ("05/03/2024", dt.date(2024, 3, 5)), ("05 Mar 24", dt.date(2024, 3, 5)),
    ("Mar 05, 2024", dt.date(2024, 3, 5)), ("05/03/24", dt.date(2024, 3, 5)), ("05 Mar 95", dt.date(1995, 3, 5)),
    ("05/03/68", dt.date(2068, 3, 5)), ("29 Feb 96", dt.date(1996, 2, 29)), ("junk", None), ("31/02/2024", None), (None, None),
])
def test_parse_date(one, raw, day):
    assert one(dates.parse_date, raw, schema="d string") == [day]


def test_iso_only_and_age(one):
    assert one(lambda c: dates.parse_date(c, iso_only=True), "2024-03-05", "05/03/2024", schema="d string") == [
        dt.date(2024, 3, 5), None]
    assert one(lambda c: dates.age_days(dates.parse_date(c), "2024-03-15"), "2024-03-05", "junk", schema="d string") == [10, 180]


def test_location_and_zone(one):
    places = [" สุขุมวิท", "Sukhumvit", "สุขุมวิทร์", "\tสุขุมวิท\t", "Nowhere ", None]
    assert one(text.normalise_location, *places, schema="l string") == ["สุขุมวิท"] * 4 + ["Nowhere", None]
    assert one(text.zone_of, "สุขุมวิท", "จตุจักร", "บางแค", "รังสิต", "x", None, schema="l string") == [
        "CBD", "Inner City", "Suburban", "Outer", "Unknown", "Unknown"]


def test_keyword_follows_list_order(one):
    got = one(lambda t: text.first_keyword(t, fixed.LOCATION_KEYWORDS),
              "Ari flat near Sukhumvit", "LAT PHRAO house", "nothing", None, schema="t string")
    assert got == ["Sukhumvit", "Lat Phrao", None, None]


def test_title_cleanup(one):
    got = one(text.clean_title, "a &amp; <br>b\\n\\t", "🏠🔥⭐x฀", None, schema="t string")
    assert got == ["a  b", "x", None]


def test_phone(one):
    titles = ["call 081-123-4567", "0๘๑-๑๒๓-๔๕๖๗", "๐๘๑-๑๒๓-๔๕๖๗", "0811234567", "12", None]
    assert one(text.has_phone, *titles, schema="t string") == [True, True, False, True, False, False]


def test_types_and_flags(one):
    assert one(text.normalise_type, " Condo ", "Land Plot", "วิลล่า ", None, schema="t string") == [
        "คอนโด", "ที่ดิน", "วิลล่า ", None]
    assert one(text.supported_type, "CONDOMINIUM", "asdf", None, schema="t string") == [True, False, False]
    assert one(text.has_text, "", "  ", "BTS x", None, "　", schema="t string") == [0, 0, 1, 0, 0]
    assert one(lambda c: text.null_tokens("t"), "N/A", "NaN", "", "x", None, schema="t string") == [None, None, None, "x", None]


def test_price_text(one):
    prices = [2_675_000.0, 1_000_000.0, 250_000.0, 99_999.4, 0.0, None]
    assert one(display.price_text, *prices, schema="p double") == [
        "฿2.67 ล้าน", "฿1.00 ล้าน", "฿2.5 แสน", "฿99,999", "฿0", "฿0"]
    assert one(display.compact, 1_234_567.0, 2_600.0, 12.0, None, schema="p double") == ["1.2M", "3K", "12", "0"]
    assert one(display.price_text, 1_005_000.0, 145_000.0, 8_570_000.0, schema="p double") == ["฿1.00 ล้าน", "฿1.4 แสน", "฿8.57 ล้าน"]
    assert one(display.compact, 1_250_000.0, 1_350_000.0, 2_500.0, 3_500.0, schema="p double") == ["1.3M", "1.4M", "3K", "4K"]
    assert one(display.short_title, "x" * 41, "ok", "", None, schema="t string") == [
        "x" * 40 + "...", "ok", "ไม่มีหัวข้อ", "ไม่มีหัวข้อ"]
    assert one(display.area_label, 50.4, 0.0, None, schema="a double") == ["50 ตร.ม.", "-", "-"]


def test_rule_estimate(one):
    rows = [(50.0, "คอนโด", "CBD", 1), (10.0, "x", "y", 0), (None, None, None, None)]
    got = one(numbers.rule_estimate, *rows, schema="a double, t string, z string, b int")
    assert got == pytest.approx([50 * 120000 * 1.5 * 1.1, 800_000.0, 50 * 120000 * 1.5])


def test_dates_with_other_shapes(one):
    texts = ["2024-03-05 10:00:00", "2024-03-05T10:00:00", "2024/03/05", "05-03-2024", "5 March 2024", "05 Mar 2024", "March 5, 2024",
             "2024-03-05T10:00:00.5+07:00", "2024-13-05", "5 Smarch 2024", "31-02-2024", ""]
    got = one(dates.parse_date, *texts, schema="t string")
    assert [str(x) for x in got] == ["2024-03-05"] * 8 + ["None"] * 4
