from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rollcall import functions as fn
from rollcall.rules import PHONE_REGIONS, PhoneRegion


def values(spark, rows, layout, column):
    return [r[0] for r in spark.createDataFrame(rows, layout).select(column).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("  Jo.Doe@Mail.COM  ", "jo.doe@mail.com"),
        ("jo . doe @ mail . com", "jo.doe@mail.com"),
        ("JO\t@\nMAIL.com", "jo@mail.com"),
        ("", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_email(spark, text, expected):
    assert values(spark, [(text,)], "e string", fn.email(F.col("e"))) == [expected]


PHONES = [
    (None, "UK", None),
    ("", "UK", None),
    (" -- ", "UK", None),
    ("+447911123456", "UK", "+447911123456"),
    ("+33612345678", "France", "+33612345678"),
    ("07911123456", "UK", "+447911123456"),
    ("0612345678", "France", "+33612345678"),
    ("+44 (791) 112-3456", "UK", "+447911123456"),
    ("abc123", "UK", "+44123"),
    ("5363309624", "UK", "+445363309624"),
    ("6482447731", "France", "+336482447731"),
    # stray trunk prefix after the calling code
    ("+44 07911 123456", "France", "+447911123456"),
    ("+3306 12 34 56 78", None, "+33612345678"),
    ("+330612345", "UK", "+330612345"),
    # other calling codes stay as they are
    ("+1 (555) 000-1111", "UK", "+15550001111"),
    ("+0123", "UK", "+0123"),
    # no known country
    ("07911 123456", "Spain", "07911123456"),
    ("07911 123456", None, "07911123456"),
    # dialled abroad, and own code without a plus
    ("0044 7911 123456", "France", "+447911123456"),
    ("0033612345678", "UK", "+33612345678"),
    ("00491234567", "UK", "+491234567"),
    ("0014155552671", "UK", "+14155552671"),
    ("00353861234567", "UK", "+353861234567"),
    ("00 49 151 12345678", "France", "+4915112345678"),
    ("+353 0 86 1234567", None, "+353861234567"),
    ("00 353 0 86 1234567", "UK", "+353861234567"),
    ("00 39 06 1234 5678", "France", "+390612345678"),
    ("0049 1", "UK", "+4400491"),
    ("0049 1234", "UK", "+491234"),
    ("00999 1234567", "UK", "+44009991234567"),
    # digits of other scripts
    ("＋４４ ７９１１ １２３４５６", "UK", "+447911123456"),
    ("٠٧٩١١١٢٣٤٥٦", "UK", "+447911123456"),
    ("०६१२३४५६७८", "France", "+33612345678"),
    ("447911123456", "UK", "+447911123456"),
    ("4407911123456", "UK", "+447911123456"),
    ("33612345678", "France", "+33612345678"),
    ("448001111", "UK", "+448001111"),
    ("447911123", "UK", "+44447911123"),
    # too long, extension digits glued on
    ("07911123456 ext 5", "UK", "+44079111234565"),
    # plus signs in odd places
    ("++447911123456", "UK", "+447911123456"),
    ("07911123456+", "UK", "+447911123456"),
    ("079+11", "UK", "+44079+11"),
    # a leading zero that cannot be dropped
    ("012345678", "UK", "+44012345678"),
]


@pytest.mark.parametrize(("text", "country", "expected"), PHONES)
def test_phone(spark, text, country, expected):
    column = fn.phone(F.col("p"), F.col("c"))
    assert values(spark, [(text, country)], "p string, c string", column) == [expected]


def brute_phone(text, country):
    """The rule again, step by step, by string lengths."""
    if text is None:
        return None
    ascii_text = "".join(str(int(c)) if c.isdecimal() else "+" if c in "＋﹢" else c for c in text)
    kept = "".join(c for c in ascii_text if c in "0123456789+")
    if not kept:
        return None
    regions = {r.country: r for r in PHONE_REGIONS if r.country}
    bare = kept.strip("+")

    def possible(digits, region):
        rest = digits.removeprefix(region.trunk_prefix)
        if digits.startswith(region.trunk_prefix) and len(rest) in region.lengths:
            return f"+{region.calling_code}{rest}"
        if len(digits) in region.possible_lengths:
            return f"+{region.calling_code}{digits}"
        return None

    def coded(digits):
        for region in PHONE_REGIONS:
            if digits.startswith(region.calling_code):
                return possible(digits.removeprefix(region.calling_code), region)
        return None

    if kept.startswith("+"):
        return (coded(bare) if bare.isdigit() else None) or kept
    if country not in regions:
        return kept
    region, found = regions[country], None
    abroad = kept.startswith("00") and not kept.startswith("000")
    known = any(re.match(rf"00{r.calling_code}\d{{4}}", kept) for r in PHONE_REGIONS)
    if bare.isdigit():
        national = bare[2:].removeprefix("0") if bare[2:].startswith("0") else bare[2:]
        valid = re.compile(region.national_pattern).fullmatch
        if abroad:
            found = coded(bare[2:])
        elif bare.startswith(region.calling_code) and (
            len(bare) > max(region.lengths) or (not valid(bare) and valid(national))
        ):
            found = possible(national, region)
        else:
            found = possible(bare, region)
    if abroad and known:
        return found or f"+{kept[2:]}"
    return found or f"+{region.calling_code}{kept}"


def test_phone_against_brute_force(spark):
    chance = random.Random(7)
    starts = ["", "0", "00", "000", "+", "++", "44", "33", "0044", "0033", "+44", "+33",
              "+440", "+330", "440", "330", "00440", "4400", "8", "448", "+1", "0049",
              "001", "+49", "+490", "00353", "+3530", "0039", "+36", "+3606", "+7", "00972", "００44", "٠٧"]
    rows = []
    for _ in range(6000):
        body = "".join(chance.choice("0123456789") for _ in range(chance.randint(0, 14)))
        if chance.random() < 0.1:
            spot = chance.randint(0, len(body))
            body = body[:spot] + chance.choice(["+", " ", "-", "(", "x"]) + body[spot:]
        text = chance.choice(starts) + body
        rows.append((text, chance.choice(["UK", "France", "Spain", None])))
    df = spark.createDataFrame(rows, "p string, c string")
    got = df.select("p", "c", fn.phone(F.col("p"), F.col("c")).alias("n")).collect()
    wrong = [(r.p, r.c, r.n) for r in got if r.n != brute_phone(r.p, r.c)]
    assert not wrong, wrong[:5]


def test_phone_regions_are_a_parameter(spark):
    spain = PhoneRegion(country="Spain", calling_code="34", lengths=(9,))
    germany = PhoneRegion(calling_code="49", lengths=(10, 11))
    column = fn.phone(F.col("p"), F.col("c"), (*PHONE_REGIONS[:2], spain, germany))
    rows = [("612345678", "Spain"), ("0049 0301234567 8", "Spain"), ("0791", "Germany")]
    assert values(spark, rows, "p string, c string", column) == [
        "+34612345678", "+493012345678", "0791",
    ]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2021-10-15", dt.date(2021, 10, 15)),
        ("20211015", dt.date(2021, 10, 15)),
        ("2021-1-5", None),
        ("2021-02-30", None),
        ("20211301", None),
        (" 2021-10-15", None),
        ("2021-10-15 ", None),
        ("2021/10/15", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    assert values(spark, [(text,)], "d string", fn.parse_date(F.col("d"))) == [expected]


def test_match_quality_bounds_are_inclusive(spark):
    rows = [(1.0,), (0.8,), (0.79,), (0.5,), (0.49,), (0.0,), (None,)]
    assert values(spark, rows, "c double", fn.match_quality(F.col("c"))) == [
        "high", "high", "medium", "medium", "low", "low", "low",
    ]


AS_OF = dt.date(2024, 2, 29)


@pytest.mark.parametrize(
    ("registered", "days", "months"),
    [
        (dt.date(2024, 2, 29), 0, 0.0),
        (dt.date(2024, 1, 31), 29, 1.0),  # both month ends
        (dt.date(2023, 2, 28), 366, 12.0),
        (dt.date(2024, 2, 14), 15, 0.5),
        (dt.date(2024, 3, 30), -30, -1.0),
        (None, None, None),
    ],
)
def test_tenure(spark, registered, days, months):
    df = spark.createDataFrame([(registered,)], "d date").select(
        fn.tenure_days(F.col("d"), AS_OF), fn.tenure_months(F.col("d"), AS_OF)
    )
    assert tuple(df.first()) == (days, months)


def test_is_active_is_inclusive_and_never_null(spark):
    rows = [(AS_OF - dt.timedelta(days=n),) for n in (0, 365, 366)] + [(None,)]
    assert values(spark, rows, "d date", fn.is_active(F.col("d"), AS_OF)) == [
        True, True, False, False,
    ]


def test_reference_day_defaults_to_today(spark):
    recent = dt.date.today() - dt.timedelta(days=30)
    assert values(spark, [(recent,)], "d date", fn.is_active(F.col("d"))) == [True]


def test_data_quality_score(spark):
    layout = "email string, phone string, address string, city string, country string"
    rows = [
        ("e", "+44", "a", "c", "k"),
        (None, "+44", "a", "c", "k"),
        ("e", "079", "a", "c", "k"),
        ("e", None, "a", "c", "k"),
        (None, None, None, None, None),
    ]
    scores = [100, 75, 85, 85, 10]
    assert values(spark, rows, layout, fn.data_quality_score()) == scores


def test_percentage(spark):
    rows = [(1, 3), (2, 3), (1, 8), (0, 5), (0, 0)]
    column = fn.percentage("a", "b")
    got = values(spark, rows, "a bigint, b bigint", column)
    assert got == [33.33, 66.67, 12.5, 0.0, 0.0]


PATTERNS = [
    "yyyy-MM-dd", "yyyyMMdd", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd['T'HH:mm:ss]", "yyyy[-MM[-dd]]",
    "d. MMM yyyy", "'on' yyyy-MM-dd", "yyyy''MM''dd",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_dates_are_what_spark_parses(spark, pattern):
    texts = [
        "2024-01-05", "20240105", "05/01/2024", "2024-01-05T00:00:00", "2024-01", "2024", "5. Jan 2024", "on 2024-01-05",
        "2024'01'05", "2024-02-30", "", " ", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(fn.parse_date(F.col("t"), (pattern,)), F.try_to_date("t", pattern)).collect()
    assert [r[0] for r in got] == [r[1] for r in got]
    assert any(r[1] for r in got)
