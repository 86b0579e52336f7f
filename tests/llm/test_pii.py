import re

import pytest

import llm_texts as texts
from hayloft.llm import pii

TEXT = (
    "Write to Anna.Keller@mail.example.com or ANNA.KELLER@MAIL.EXAMPLE.COM, call +1 (555) 123-4567 from 10.20.30.40. "
    "Card 4111 1111 1111 1111 (4111111111111111), IBAN DE89 3704 0044 0532 0130 00, SSN 123-45-6789, "
    'token = "0a1b2c3d4e5f60718293a4b5c6d7e8f9". Anna Keller met Dr. Weber; Keller and Weber left. '
    "Мария Петрова и Иван звонили. Version 1.2.3, 12:30, 2024-01-02."
)


def replaced(spark, rows, **options):
    df = texts.with_clashing_columns(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    return pii.replace_personal_data(df, **options).collect()


def test_formats_types_and_coreference(spark):
    (row,) = replaced(spark, [(1, TEXT)])
    out = row.surrogate_text
    for leaked in ("Keller", "Weber", "KELLER", "123-4567", "10.20.30.40", "4111", "0532", "123-45-6789", "0a1b2c", "Петрова"):
        assert leaked not in out
    assert (row.n_email, row.n_ip, row.n_iban, row.n_ssn, row.n_card, row.n_phone, row.n_secret) == (2, 1, 1, 1, 2, 1, 1)
    assert "Version 1.2.3, 12:30, 2024-01-02." in out
    a, b = re.findall(r"[\w.]+@[\w.]+", out)[:2]
    assert b.rstrip(",.") == a.upper() and re.fullmatch(r"[a-z]{4}\.[a-z]{6}@[a-z]{4}\.[a-z]{7}\.com", a)
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", out)
    spaced, plain = re.search(r"Card (4[\d ]{18}) \((4\d{15})\)", out).groups()
    assert spaced.replace(" ", "") == plain and pii._luhn(plain)
    assert pii._iban_ok(re.search(r"DE\d\d( \d{4}){4} \d\d", out).group().replace(" ", ""))
    assert re.search(r'token = "[0-9a-f]{32}"', out)
    given, family, title, again, again_title = re.search(r"\. (\S+) (\S+) met Dr\. (\S+); (\S+) and (\S+) left", out).groups()
    assert pii._GIVEN[given] == ("latin", "f") and given != "Anna"
    assert (family, title) == (again, again_title)
    woman, man = re.search(r"left\. (\S+) \S+ и (\S+) ", out).groups()
    assert pii._GIVEN[woman] == ("cyrillic", "f") and pii._GIVEN[man] == ("cyrillic", "m")


def test_keyed_and_stable(spark):
    one, again, other = (replaced(spark, [(1, TEXT)], key=k)[0].surrogate_text for k in (b"a", b"a", b"b"))
    assert one == again != other


def test_distinct_entities_stay_distinct_across_documents(spark):
    # a crowded format: two-letter addresses, many of which collide at first
    rows = [(i, f"x {a}{b}@a.de y {a}{b}@a.de") for i, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "abcdefghij")]
    got = replaced(spark, rows)
    pairs = {r.doc_id: re.findall(r"\S+@\S+", r.surrogate_text) for r in got}
    assert all(len(set(p)) == 1 and len(p) == 2 for p in pairs.values())
    drawn = {p[0] for p in pairs.values()}
    assert len(drawn) == len(rows)
    assert not drawn & {f"{a}{b}@a.de" for a in "abcdefghij" for b in "abcdefghij"}


def test_given_names_are_permuted_within_gender_and_script():
    for (script, gender), names in pii.GIVEN_NAMES.items():
        new = [pii.surrogate(b"k", "given", n) for n in names]
        assert sorted(new) == sorted(names) and all(a != b for a, b in zip(names, new))


@pytest.mark.parametrize("seed", [1, 2])
def test_text_without_personal_data_is_unchanged(spark, seed):
    rows = [(r[0], r[1]) for r in texts.document_rows(seed)]
    got = {(r.doc_id, r.surrogate_text) for r in replaced(spark, rows)}
    untouched = {(i, t) for i, t in rows if not pii.find(t or "")}
    assert untouched <= got and len(untouched) > 50


def test_long_runs_take_linear_time():
    import time

    began = time.time()
    for run in ("x" * 300_000, "a." * 150_000, "a@" * 100_000, "1" * 300_000, "Anna " * 50_000, "A1" * 100_000):
        pii.find(run)
    assert time.time() - began < 20
    assert [e[2:] for e in pii.find("..joe@x.org")] == [("email", "..joe@x.org")]


def test_empty_table(spark):
    assert pii.replace_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def entities(text):
    return [(text[a:b], kind) for a, b, kind, _ in pii.find(text)]


@pytest.mark.parametrize("iban", ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT611904300234573201",
                                  "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"])
@pytest.mark.parametrize("after", ["", " BIC", " 2024", ", x", " AB"])
def test_iban_ends_before_the_next_token(iban, after):
    assert entities("to " + iban + after) == [(iban, "iban")]


def test_iban_after_a_token_that_looks_like_one():
    assert entities("XX12 3456 ES91 2100 0418 4502 0005 1332") == [("ES91 2100 0418 4502 0005 1332", "iban")]
    assert entities("DE89 3704 0044 0532 0130 01") == []


@pytest.mark.parametrize("phone", ["+33 6 12 34 56 78", "06 12 34 56 78", "612 345 678", "030 1234567", "555.123.4567",
                                   "+49 30 1234567", "020 7946 0958", "0044 20 7946 0958", "+1 555 123 4567"])
@pytest.mark.parametrize("before, after", [("", ""), ("call ", " 2024"), ("call ", ", 12"), ("(", ")")])
def test_phones_of_several_countries(phone, before, after):
    assert (phone, "phone") in entities(before + phone + after)


@pytest.mark.parametrize("card", ["4929348385146306", "4111 1111 1111 1111", "3782 822463 10005", "4111-1111-1111-1111"])
@pytest.mark.parametrize("before, after", [("", " 123"), ("12 ", ""), ("no ", " 2024"), ("", " 4111111111111111"), ("", "")])
def test_cards_without_the_numbers_beside_them(card, before, after):
    assert (card, "card") in entities(before + card + after)
    assert ("123-45-6789", "ssn") in entities(card + " 123-45-6789")


def test_numbers_that_are_no_phones():
    assert entities("Version 1.2.3, 12:30, 2024-01-02, 01-02-2024, +1 2 3, 1.234.567.890, 10 000 000") == []


@pytest.mark.parametrize("mentions", [
    ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "001 555 123 4567"],
    ["+33612345678", "+33 6 12 34 56 78", "0033 612 345 678"],
    ["+351912345678", "+351 912 345 678"],
])
def test_spellings_of_a_number_share_a_surrogate(spark, mentions):
    (row,) = replaced(spark, [(1, " ; ".join(mentions))])
    assert row.n_phone == len(mentions)
    new = row.surrogate_text.split(" ; ")
    digits = {re.sub(r"\D", "", re.sub("^00", "+", n)) for n in new}
    code = re.match(r"\+(1|33|351)", mentions[0]).group(1)
    assert len(digits) == 1 and digits.pop().startswith(code)
    assert [re.sub(r"\d", "9", n) for n in new] == [re.sub(r"\d", "9", m) for m in mentions]  # each in its own layout
    assert not set(new) & set(mentions)


def test_distinctness_and_coreference_of_a_table(spark):
    """Brute force over all mentions of a corpus: one surrogate an entity, one entity a surrogate, none that exists."""
    import random

    rng = random.Random(4)
    made = [f"{rng.randrange(100, 999)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}" for _ in range(40)]
    made += [f"+1 555 {rng.randrange(200, 999)} {rng.randrange(1000, 9999)}" for _ in range(40)]
    made += [f"user{i}@example.org" for i in range(40)] + [f"10.0.{i}.{i + 1}" for i in range(40)]
    rows = [(i, " | ".join(rng.choice(made) for _ in range(12))) for i in range(120)]
    got = {r.doc_id: r.surrogate_text.split(" | ") for r in replaced(spark, rows)}
    of, back = {}, {}
    for i, text in rows:
        for before, after in zip(text.split(" | "), got[i]):
            assert of.setdefault(before, after) == after and back.setdefault(after, before) == before
    assert not set(back) & set(made)


def test_a_format_that_runs_out_grows(spark):
    """Every number a short format has is taken: the replacements get longer, none fails."""
    entities = spark.createDataFrame([("secret", f"{i:x}") for i in range(16)], "kind string, value string")
    rows = pii.assign_surrogates(entities, b"k").collect()
    assert len(rows) == len({r.surrogate for r in rows}) == 16
    assert not {r.surrogate for r in rows} & {r.value for r in rows}


def test_a_text_over_one_mebibyte():
    text = "word " * 220_000 + "call +33 6 12 34 56 78"
    assert entities(text) == [("+33 6 12 34 56 78", "phone")]


def test_searches_find_what_one_alternation_finds():
    """The searches taken together against one pattern of all alternatives, at every place where a search may go on."""
    import random

    pieces = [pii._EMAIL, pii._IBAN, pii._NUMBER, pii._SECRET, pii._PERSON, pii._TITLED]
    union = re.compile("|".join(p.pattern for p in pieces))
    rng = random.Random(7)
    bits = ["Anna", "Мария", "Άννα", " ", " ", ".", ",", "@", "a@b.de", "+", "(", ")", "-", "555", "4567", "0", "12", "+33",
            "DE89", "3704", "X", "token", "ſecret", "PASSWORD", ":", "=", "abcd1234ef", "Mr", "Dr.", " Weber", " Keller-Lang",
            "10.0.0.1", "123-45-6789", "4111 1111 1111 1111", "_", "x", "\n", "٣", "xAnna", "Madame", "Mme"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        at, ahead = 0, [None] * len(pii._SEARCHES)
        while m := pii._leftmost(text, at, ahead):
            plain = union.search(text, at)
            assert (m.span(), m.group()) == (plain.span(), plain.group())
            at = m.start() + rng.randrange(1, m.end() - m.start() + 1)
        assert union.search(text, at) is None
