import pytest
from pyspark.sql import functions as F

from firmament.functions import contacts as C
from firmament.functions import html as H
from firmament.functions import normalize as N
from firmament.functions import registry as R
from firmament.functions import urls as U


def evaluate(spark, cases):
    """Values of many expressions in one job."""
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cases)]).first()
    return list(row)


def check(spark, fn, table):
    got = evaluate(spark, [fn(*[F.lit(a) if not isinstance(a, list) else F.array(*map(F.lit, a)).cast("array<string>") for a in (k if isinstance(k, tuple) else (k,))]) for k, _ in table])
    assert got == [v for _, v in table]


def test_website(spark):
    check(spark, N.normalize_website, [
        ("http://www.akbsokolov.com/", "akbsokolov.com"),
        ("https://AKBSokolov.COM", "akbsokolov.com"),
        ("akbsokolov.com/", "akbsokolov.com"),
        (" https://http://www.a.ru/p?q=1// ", "a.ru/p?q=1"),
        ("www.www.a.ru", "www.a.ru"),
        ("https://", None),
        ("\u00a0A.ru\u00a0", "a.ru"),
    ])


def test_names(spark):
    check(spark, N.normalize_name, [
        ('ООО «Тигр-М» (Москва)', "ооо тигр м москва"),
        ('"Щит",  плюс!', "щит плюс"),
        ("А – Б\u00a0— В", "а б в"),
        ("  ", ""),
    ])


def test_phones(spark):
    check(spark, N.digits, [("+7 (495) 123-45-67", "74951234567"), ("нет", "")])
    check(spark, N.dedup_phones, [
        (["+7 (495) 123-45-67 (факс)", "+7 (495) 123-45-67"], ["+7 (495) 123-45-67"]),
        (["12-34", " 8 495 1112233 (круглосуточно) ", ""], ["8 495 1112233"]),
        ([], []),
    ])
    check(spark, C.format_phone, [
        ("8 (495) 123-45-67", "+7 (495) 123-45-67"),
        ("4951234567", "+7 (495) 123-45-67"),
        ("+1 495 123 45 67", None),
        ("123", None),
    ])
    assert evaluate(spark, [N.phone_fingerprint(F.lit("8 495 123-45-67"), unify_prefix=True)]) == ["74951234567"]


def test_lists(spark):
    check(spark, N.dedup_emails, [([" A@b.ru", "a@B.RU", " ", "c@d.ru"], ["a@b.ru", "c@d.ru"])])
    check(spark, N.clean_kpp_list, [(["123 456 789", "123456789", "1"], ["123456789"])])
    check(spark, N.as_list, [(" ", []), ("x", ["x"])])
    check(spark, N.contact_summary, [((["1"], [], ["1", "2"]), "[тел:1 кпп:2]"), (([], [], []), "")])


def test_identifiers(spark):
    check(spark, N.clean_inn, [("77-0000 0001", "7700000001"), ("123456789012", "123456789012"), ("12345678901", None), ("", None)])
    check(spark, N.clean_ogrn, [("1027700000001", "1027700000001"), ("1", None)])


@pytest.mark.parametrize("text,expected", [
    ("2021-06-17", "2021-06-17"), ("17.06.2021", "2021-06-17"), ("7.6.2021", "2021-06-07"),
    ("2021-06-17T10:20:30", "2021-06-17"), ("2021-06-17 10:20:30", "2021-06-17"),
    ("2021-02-30", None), ("17/06/2021", None), ("", None),
])
def test_dates(spark, text, expected):
    assert evaluate(spark, [N.parse_date(F.lit(text)).cast("string")]) == [expected]


def test_registry_forms(spark):
    check(spark, N.dotted_to_iso, [("17.06.2021", "2021-06-17"), ("1.2", "1.2"), ("a.b.c", "a.b.c")])
    check(spark, R.director_name, [("ГЕНЕРАЛЬНЫЙ ДИРЕКТОР: Иванов Иван", "Иванов Иван"), ("Иванов", "Иванов"), ("", None), ("Д: ", None)])
    check(spark, R.infer_status, [
        (("17.06.2021", "ЛИКВИДАТОР: А"), "LIQUIDATED"), (("", "Ликвидатор: А"), "LIQUIDATING"),
        (("", "конкурсный управляющий: А"), "BANKRUPT"), (("", "Арбитражный управляющий"), "BANKRUPT"),
        (("", "Директор"), "ACTIVE"), (("", ""), "ACTIVE"),
    ])
    check(spark, R.map_provider_status, [("BANKRUPT", "BANKRUPT"), ("x", "UNKNOWN"), (None, "UNKNOWN")])
    check(spark, R.epoch_ms_to_date, [(1623888000000, "2021-06-17"), (0, None), (None, None)])
    none = F.lit(None).cast("string")
    assert evaluate(spark, [
        R.report_status(F.lit("LIQUIDATED"), F.lit("2021-06-17"), F.lit("1")),
        R.report_status(F.lit("ACTIVE"), none, F.lit("1")), R.report_status(none, none, none),
        R.report_status(none, none, F.lit("1")),
    ]) == ["LIQUIDATED|2021-06-17", "ACTIVE", "NO_INN", "PENDING"]
    check(spark, R.status_label, [("LIQUIDATED|2021-06-17", "✗ Ликвидировано\n2021-06-17"), ("ZZ", "ZZ"), ("", None)])


def test_email_validity(spark):
    long_local = "a" * 65 + "@b.ru"
    check(spark, C.is_valid_email, [
        ("info@firm.ru", True), (" INFO@firm.ru ", True), ("a@@firm.ru", False), ("a@firm", False), ("@firm.ru", False),
        ("logo@2x.png", False), ("noreply@firm.ru", False), ("x@example.com", False), ("x@mail.example.com", False),
        ("x@notexample.com", True), (long_local, False), (None, False),
    ])


def test_protected_email(spark):
    plain, key = "me@firm.ru", 0x54
    code = f"{key:02x}" + "".join(f"{ord(c) ^ key:02x}" for c in plain)
    check(spark, C.decode_protected_email, [(code, plain), (code.upper(), plain), ("zz11", None), ("54", None)])


def test_urls(spark):
    base = "https://h.ru/a/b?q=1"
    check(spark, U.resolve, [((base, h), v) for h, v in [
        ("c", "https://h.ru/a/c"), ("/c", "https://h.ru/c"), ("../c", "https://h.ru/c"), ("../../../c", "https://h.ru/c"),
        ("?z", "https://h.ru/a/b?z"), ("#f", "https://h.ru/a/b?q=1#f"), ("//o.ru/x", "https://o.ru/x"),
        ("http://k.ru", "http://k.ru"), ("./c/../d?x=1#y", "https://h.ru/a/d?x=1#y"), ("", base), ("..", "https://h.ru/"),
    ]])
    check(spark, U.netloc, [("https://А_б.рф:80/p a", "а_б.рф:80"), ("/x", "")])
    check(spark, U.same_site, [
        (("https://a.ru", "https://www.a.ru/x"), True), (("https://www.a.ru", "http://m.a.ru"), True),
        (("https://a.ru", "https://b.ru"), False), (("https://a.ru", "https://a.ru.timeweb.ru"), False),
        (("https://x.reg.ru", "https://x.reg.ru/p"), True),
    ])
    check(spark, U.unwrap_website, [(("/link/?url=x.ru&y=1", "t"), "x.ru"), (("http://x.ru", "t"), "http://x.ru"), (("/go", "t.ru"), "t.ru"), (("", "t"), None)])
    check(spark, U.drop_query, [(("http://x.ru/?utm_source=1", ""), "http://x.ru/"), (("/go", "t.ru"), "t.ru")])


def test_idempotent(spark):
    raw = ["http://www.a.ru/", "ООО «А-Б»", " A@b.ru ", "+7 (495) 123-45-67 (факс)"]
    for fn in (N.normalize_website, N.normalize_name, N.canonical_email, N.strip_phone_annotation, N.digits):
        once = evaluate(spark, [fn(F.lit(v)) for v in raw])
        assert evaluate(spark, [fn(F.lit(v)) for v in once]) == once


def test_unescape(spark):
    check(spark, H.unescape, [("a&#64;b&#x2E;ru &amp;lt; &nbsp;|", "a@b.ru &lt; \u00a0|"), ("&#55296;", "&#55296;"), ("x", "x")])
