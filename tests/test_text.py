import pytest
from pyspark.sql import functions as F

from kinloom.functions import text as T
from kinloom.functions.keys import probe_keys

NUMBERS = [
    ("Flat No.31, Lake Road, Pune", "31"),
    ("Shop No 64, 9Th Main, Mysuru", "64"),
    ("Plot NO. -27/4, PUNE CITY", "27"),
    ("88 Oak Avenue, Tulsa, OK", "88"),
    ("310-B Harbour St, Portland, ME", "310"),
    ("Clock Tower, Old Market, Jaipur", ""),
    ("", ""),
    (None, ""),
    ("7 Quay, Flat NO.31, y", "31"),
    ("xNo7 3", "7"),
    ("003 Row", "003"),
    ("No 5", "5"),
    ("No\u00a06, x", "6"),
    ("Block \u0967\u0968", "\u0967\u0968"),
]
# Names and addresses with their probe keys; "new" is a frequent word.
RECORDS = [
    ("Maud's Pie Shop", "88 Oak Avenue, Tulsa, OK", "US", "us::name:mau us::nrev:sho us::city:ok us::housenum:88"),
    ("C+ Trading Inc", "9 Elm Court, Denver, CO", "US", "us::name:c us::nrev:tra us::city:co us::housenum:9"),
    ("Pvt. ZRT Paper Works Ltd.", "Shop No 64, 9Th Main, Mysuru, Karnataka", "India", "india::name:zrt india::nrev:wor india::city:karnataka india::housenum:64"),
    ("गंगा वस्त्र भंडार लिमिटेड", "Plot NO. -27/4, PUNE CITY, Maharashtra", "India", "india::name:गंग india::nrev:लिम india::city:maharashtra india::housenum:27"),
    ("-- Grelling Mill Inc Bakery", "88 OAK AVE, TULSA, OK", "US", "us::name:gre us::nrev:bak us::city:ok us::housenum:88"),
    ("<< Studio Lumen", "12 Rue des Lilas, Nantes, Pays-de-la-Loire", "France", "france::name:stu france::nrev:lum france::city:pays-de-la-loire france::housenum:12"),
    ("LLC Norwood Music School", "41 Birch Ln, El Paso, Texas", "US", "us::name:nor us::nrev:sch us::city:texas us::housenum:41"),
    ("New Jaipur Carpets", "Clock Tower, Old Market, Jaipur", "India", "india::name:jai india::nrev:car india::city:jaipur"),
    ("Tessovar", "310-B Harbour St, Portland, ME", "US", "us::name:tes us::nrev:tes us::city:me us::housenum:310"),
    ("New", "", "US", "us::name:new us::nrev:new"),
    ("", "", "", "::empty"),
    (None, None, None, "::empty"),
]


def values(spark, rows, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, c string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_house_numbers(spark):
    assert values(spark, [a for a, _ in NUMBERS], T.house_number("c")) == [b for _, b in NUMBERS]


def test_probe_keys(spark):
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(RECORDS)], "i int, business_name string, business_address string, country string")
    found = [" ".join(k.key for k in r.k) for r in df.select("i", probe_keys(["new"]).alias("k")).orderBy("i").collect()]
    assert found == [r[3] for r in RECORDS]


def test_noise(spark):
    given = ["-- Grelling Mill", "<< Studio^Lumen.\n", " B+ ", "&?_x&", "a\\/b\\", "...", "", "\x1cq\x1d", "a \t b", "　गंगा।"]
    assert values(spark, given, T.strip_noise("c")) == ["Grelling Mill", "Studio^Lumen", "B", "&?_x&", "a\\/b", "", "", "q", "a b", "गंगा।"]


@pytest.mark.parametrize(("name", "words"), [("The Company Ltd", "the"), ("ЗАО Берёза", "ЗАО|Берёза"), ("TK-Motoren LLC", "tk|motoren"), ("", ""), ("Pvt. Ltd.", "pvt")])
def test_tokens(spark, name, words):
    assert values(spark, [name], F.concat_ws("|", T.significant_tokens("c"))) == [words]


def test_examples_and_lists(spark):
    df = spark.createDataFrame([(["b", "a"],), (list("gfedcba"),), ([],)], "c array<string>")
    assert [r.v for r in df.select(T.show_examples(F.col("c")).alias("v")).collect()] == ["a, b", "7 total, e.g. a, b, c, d, e, ...", ""]
    assert values(spark, ["a,b,", "", " \t", "a"], F.size(T.decode_ids("c"))) == [3, 0, 0, 1]


def test_canonical_words(spark):
    assert values(spark, ["Near Big Mall, 5 Main Rd., X Corp"], T.canonical_words("c")) == ["5 main road, x corporation"]
