"""Surrogates for personal data.

Entities are found by pattern in whole texts, brought to one form per entity
(the case of an address or the spacing of a number does not matter), and each
distinct entity of the corpus gets one surrogate, so mentions stay coreferent
across documents. A surrogate is drawn with a keyed hash and keeps type and format:
digit for digit and letter for letter, the issuer digit and check digit of a
card, the country and check digits of an IBAN, the country code of a phone
number, gender and script of a given name, script of a family name.

Collisions are settled in Spark over the distinct entities: a surrogate may
neither belong to two entities nor equal any entity found in the corpus; who loses
draws again. Given names are permuted within their list by the key, which cannot
collide, and persons are replaced part by part, so "Anna Keller" and a later
"Keller" in the same document stay the same person.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm.tables import stored, text_key

#: Common given names by script and gender.
GIVEN_NAMES = {
    ("latin", "f"): "Anna Maria Laura Sarah Emma Julia Claire Sophie Elena Carmen Linda Susan Helen Alice Ingrid Lucía".split(),
    ("latin", "m"): "James John Robert Michael David Thomas Daniel Peter Paul Martin Hans Pierre Carlos Pablo Antoine Karl".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Николай Михаил Андрей Павел".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Δήμητρα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παύλος".split(),
}
#: Titles that a family name may follow.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora".split()

_GIVEN = {name: key for key, names in GIVEN_NAMES.items() for name in names}
_FAMILY = r"[^\W\d_]+(?:-[^\W\d_]+)*"
_PHONE = (
    r"(?P<phone>(?:(?<!\w)\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<!\w)\+\d{1,3}(?:[ .-]?\d{1,4}){2,7}(?!\d)"
    r"|(?<![\d-])\d{3}-\d{3}-\d{4}(?!\d)"
    r"|(?<![\w+-])(?<!\d\.)(?:0\d(?:[ .-]\d\d){4}|0\d{1,4}(?:[ /-]\d{2,8}){1,4}"
    r"|\d{3}(?P<dot>[ .])\d{3}(?P=dot)\d{4}|[6-9]\d\d(?P<sep>[ .-])\d{3}(?P=sep)\d{3})(?!\d))"
)


def _by_first_letter(words) -> str:
    """One of the words at the start of a word. A set of first letters leads, which the search skips to."""
    letters = "[" + "".join(sorted({w[0] for w in words})) + "]"
    rests = {c: sorted((w[1:] for w in words if w[0] == c), key=len, reverse=True) for c in letters[1:-1]}
    return rf"{letters}(?<!\w{letters})(?:" + "|".join(f"(?<={c})(?:{'|'.join(r)})" for c, r in rests.items()) + ")"


# One pattern per way to begin, each led by what the search can skip to; see _leftmost.
# only from the start of a run of address characters: linear on long runs without an @
_ADDRESS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
# the groups after an IBAN, a card or a phone may be other numbers: where it ends is settled in find
_IBAN = re.compile(r"(?P<iban>[A-Z]{2}\d{2}(?<!\w[A-Z]{2}\d{2})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)")
_NUMBER = re.compile(
    r"(?<![\w.])(?P<ip>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?![\w]|\.\d)"
    r"|(?<!\d)(?P<ssn>\d{3}-\d{2}-\d{4})(?!\d)"
    r"|(?<![\d+])(?P<card>\d(?:[ -]?\d){12,37})"
    r"|" + _PHONE
)
_NUMBER_START = re.compile(r"[\d+(](?:(?<=\d)\d+)?")  # none of them begins inside a run of digits
# (ſ equals s where case does not count)
_SECRET = re.compile(
    r"[AaPpSsTtſ](?<!\w[AaPpSsTtſ])(?i:(?:(?<=t)oken|(?<=s)ecret|(?<=a)pi[_-]?key|(?<=p)ass(?:word|wd))\b\s*[:=]\s*[\"']?)"
    r"(?P<secret>[A-Za-z0-9_\-]{8,})"
)
_PERSON = re.compile(rf"(?P<given>{_by_first_letter(_GIVEN)})\b(?: (?P<family>(?=[^\W\d_]){_FAMILY}))?")
_TITLED = re.compile(rf"{_by_first_letter(TITLES)}\.? (?P<titled>{_FAMILY})")


def _email(text: str, at: int) -> re.Match | None:
    """The first address from ``at`` on, looked for from its @."""
    mark = text.find("@", at)
    while mark >= 0:
        start = mark
        while start > at and text[start - 1] in _ADDRESS:
            start -= 1
        if m := _EMAIL.match(text, start):
            return m
        mark = text.find("@", mark + 1)
    return None


def _number(text: str, at: int) -> re.Match | None:
    """The first number from ``at`` on, tried only where one may begin."""
    for start in _NUMBER_START.finditer(text, at):
        if m := _NUMBER.match(text, start.start()):
            return m
    return None


#: in order of precedence at one place
_SEARCHES = (_email, _IBAN.search, _number, _SECRET.search, _PERSON.search, _TITLED.search)


def _leftmost(text: str, at: int, ahead: list[re.Match | None]) -> re.Match | None:
    """The first match of any search from ``at`` on.

    ``ahead`` keeps the next match of each, so that a text is read once by each search.
    """
    first = None
    for i, search in enumerate(_SEARCHES):
        if at == 0 or (ahead[i] and ahead[i].start() < at):
            ahead[i] = search(text, at)
        if ahead[i] and (first is None or ahead[i].start() < first.start()):
            first = ahead[i]
    return first


_PHONE_ALONE = re.compile(_PHONE)
#: Characters of an IBAN by country; digits of a national number by country code (least, most).
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
NATIONAL_DIGITS = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9),
    "34": (9, 9), "36": (8, 9), "39": (8, 11), "40": (9, 9), "41": (9, 9), "43": (8, 13), "44": (9, 10), "45": (8, 8),
    "46": (7, 9), "47": (8, 8), "48": (9, 9), "49": (7, 11), "52": (10, 10), "55": (10, 11), "61": (9, 9), "64": (8, 10),
    "81": (9, 10), "82": (8, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "351": (9, 9), "353": (7, 9),
    "358": (6, 11), "380": (9, 9), "420": (9, 9), "421": (9, 9),
}
#: Country codes of one and of two digits; all others have three.
ONE_DIGIT_CODES = "1 7".split()
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66"
    " 81 82 84 86 90 91 92 93 94 95 98"
).split()
KINDS = ("email", "ip", "iban", "ssn", "card", "phone", "secret", "given", "family")
_DIGITS = re.compile(r"\d")
_IBAN_START = re.compile(r"\b[A-Z]{2}\d{2}")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _ends(text: str, start: int, end: int) -> list[tuple[int, str]]:
    """Every place where a number in ``text[start:end]`` may end, as no letter or digit follows, with its symbols so far."""
    out, value = [], ""
    for i in range(start, end):
        if text[i].isalnum():
            value += text[i]
            if i + 1 == len(text) or not text[i + 1].isalnum():
                out.append((i + 1, value))
    return out


def _iban_end(text: str, start: int, end: int) -> int | None:
    """The end with valid check digits: at the country's length, else the longest."""
    length = IBAN_LENGTHS.get(text[start : start + 2])
    ends = [(at, v) for at, v in _ends(text, start, end) if (len(v) >= 15 or at == end) and _iban_ok(v)]
    return max(ends, key=lambda e: (len(e[1]) == length, e[0]), default=(None,))[0]


def _card_span(text: str, start: int, end: int) -> tuple[int, int, str] | None:
    """The first card among groups of digits, without the numbers beside it; its kind is ``phone`` if none is valid."""
    groups = [m.span() for m in re.finditer(r"\d+", text[start:end])]
    if start + groups[-1][1] < len(text) and text[start + groups[-1][1]].isdigit():
        groups.pop()  # cut off by the pattern
    groups = [(start + a, start + b) for a, b in groups]
    found = []
    for i, (a, b) in enumerate(groups):
        if b - a >= 13:
            return (a, b, "card") if b - a <= 19 else None
        for _, to in groups[i:]:
            digits = "".join(_DIGITS.findall(text[a:to]))
            if 13 <= len(digits) <= 19 and to - a < len(digits) + len(groups):
                if b - a >= 4 and _luhn(digits):
                    found.append((a, to, "card"))
        if found:
            return found[-1]
    for a, _ in groups:
        phone = _PHONE_ALONE.match(text, a)
        if phone and (to := _phone_end(text, *phone.span())):
            return a, to, "phone"
    if [b - a for a, b in groups[:4]] == [4] * 4:
        return start, groups[3][1], "card"
    whole = [at for at, v in _ends(text, start, end) if 13 <= len(v) <= 19]
    return (start, whole[-1], "card") if whole else None


def _phone_end(text: str, start: int, end: int) -> int | None:
    """The longest end that has as many digits as a number of its country or, with a leading 0, of any country."""
    ends = [(at, v) for at, v in _ends(text, start, end) if v.isdigit()]
    international = next((p for p in ("+", "00") if text.startswith(p, start)), None)
    if international:
        ends = [(at, v.removeprefix(international)) for at, v in ends]
        digits = ends[-1][1] if ends else ""
        code = next((digits[:n] for n in (1, 2, 3) if digits[:n] in NATIONAL_DIGITS), None)
        least, most = NATIONAL_DIGITS[code] if code else (7, 15)
        # a trunk 0 may stand after the country code
        fits = [at for at, v in ends if least <= len(v[len(code or "") :].removeprefix("0")) <= most]
        if fits:
            return fits[-1]
        if international == "+":
            return None if len(digits) < 7 and re.search(r"[ .-]\d(?!\d)", text[start:end]) else end
    if text[start] == "0":
        pairs = re.compile(r"0\d(?:[ .-]\d\d){4}(?!\d)").match(text, start)
        fits = [pairs.end()] if pairs else [at for at, v in ends if 9 <= len(v) <= 11]
        return fits[-1] if fits else None
    return end


def _is_name(word: str) -> bool:
    return word[:1].isupper() and word[1:2].islower()


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical form)`` of every entity, left to right."""
    out, families, at, ahead = [], set(), 0, [None] * len(_SEARCHES)
    while m := _leftmost(text, at, ahead):
        groups, at = m.groupdict(), m.end()
        if "given" in groups:
            a, b = m.span("given")
            out.append((a, b, "given", m.group("given")))
            if m.group("family") and _is_name(m.group("family")):
                out.append((*m.span("family"), "family", m.group("family").casefold()))
                families.add(m.group("family"))
        elif "titled" in groups:
            if m.group("titled") in _GIVEN:
                out.append((*m.span("titled"), "given", m.group("titled")))
            elif _is_name(m.group("titled")):
                out.append((*m.span("titled"), "family", m.group("titled").casefold()))
                families.add(m.group("titled"))
        else:
            kind = next(k for k in KINDS if groups.get(k))
            a, b = m.span(kind)
            if kind == "iban":
                b = _iban_end(text, a, b)
                if b is None:  # another IBAN may begin inside the run
                    again = _IBAN_START.search(text, a + 1, at)
                    at = again.start() if again else at
                    continue
            elif kind == "card":
                span = _card_span(text, a, b)
                if span is None:
                    continue
                a, b, kind = span
            elif kind == "phone":
                b = _phone_end(text, a, b)
                if b is None:
                    continue
            at = b if kind in ("iban", "card", "phone") else at
            out.append((a, b, kind, canonical(kind, text[a:b])))
    if families:  # later or earlier mentions by family name alone
        starts, ends = [a for a, *_ in out], [b for _, b, *_ in out]  # in order, without overlaps
        again = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, families), key=len, reverse=True)) + r")\b")
        for m in again.finditer(text):
            before = bisect_right(starts, m.start())
            if (not before or ends[before - 1] <= m.start()) and (before == len(starts) or m.end() <= starts[before]):
                out.append((*m.span(), "family", m.group().casefold()))
        out.sort()
    return out


def canonical(kind: str, value: str) -> str:
    if kind == "email":
        return value.lower()
    if kind in ("card", "ssn"):
        return "".join(_DIGITS.findall(value))
    if kind == "phone":
        digits = "".join(_DIGITS.findall(value))
        if value.startswith("00"):
            digits = digits[2:]
        elif not value.startswith("+"):
            return digits
        # by the code's own length, whatever the layout of the mention
        n = 1 if digits[:1] in ONE_DIGIT_CODES else 2 if digits[:2] in TWO_DIGIT_CODES else 3
        return f"+{digits[:n]} {digits[n:]}"
    return value.replace(" ", "") if kind == "iban" else value


class _Draw:
    """An endless keyed stream of small numbers for one entity and attempt."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.block, self.pool = key, "\x00".join(map(str, what)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.what + b"\x00%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        word, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return word % n

    def like(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                new = letters[self.below(len(letters))]
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)


def _script(text: str) -> str:
    c = next((c for c in text if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin" if c < "ɐ" else "other"


_LETTERS = {
    "latin": ("bdfghklmnprstv", "aeiou"),
    "cyrillic": ("бвгдзклмнпрстф", "аеиоу"),
    "greek": ("βγδζκλμνπρστφχ", "αειου"),
}


@lru_cache
def _permuted(key: bytes, script: str, gender: str) -> dict[str, str]:
    """A keyed rotation of the names in keyed order: no name stays, none is used twice."""
    names = sorted(GIVEN_NAMES[script, gender], key=lambda n: hmac.new(key, n.encode(), hashlib.sha256).digest())
    return dict(zip(names, names[1:] + names[:1]))


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement for a canonical form; another attempt gives another one.

    Formats too short to hold twice the entities found grow after eight attempts, by
    a letter or digit an attempt, so a free replacement is always reached.
    """
    draw = _Draw(key, kind, value, attempt)
    more = max(0, attempt - 8)
    longer = "x" * more
    if kind in ("card", "ssn", "phone"):
        value += "0" * more
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{draw.like(local + longer)}@{draw.like(host)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4 + more))
    if kind == "card":
        body = value[0] + draw.like(value[1:-1])
        valid = _luhn(value)
        last = next(d for d in "0123456789" if _luhn(body + d))
        return body + (last if valid else str((int(last) + 1 + draw.below(9)) % 10))
    if kind == "iban":
        body = "".join(
            str(draw.below(10)) if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[draw.below(26)] for c in value[4:] + "0" * more
        )
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    if kind == "phone":
        country, _, rest = value.rpartition(" ")
        trunk = "0" * rest.startswith("0")  # a national number keeps its leading 0
        rest = trunk + draw.like(rest[len(trunk) :])
        return f"{country} {rest}" if country else rest
    if kind == "secret":
        hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value)
        if hexadecimal:
            digits = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
            return "".join(digits[draw.below(16)] for _ in value + longer)
        return draw.like(value + longer)
    if kind == "given":
        script, gender = _GIVEN[value]
        return _permuted(key, script, gender)[value]
    if kind == "family":
        consonants, vowels = _LETTERS.get(_script(value), _LETTERS["latin"])
        return "".join(
            c if not c.isalpha() else (vowels[draw.below(len(vowels))] if i % 2 else consonants[draw.below(len(consonants))])
            for i, c in enumerate(value + longer)
        )
    return draw.like(value)  # ssn


def render(kind: str, original: str, replacement: str) -> str:
    """The surrogate in the layout of the mention: its spacing, or its case."""
    if kind in ("card", "ssn", "phone", "iban"):
        symbols = iter(c for c in replacement if c.isalnum())
        prefix = "00" if kind == "phone" and replacement.startswith("+") and original.startswith("00") else ""
        laid_out = "".join(next(symbols, "0") if c.isalnum() else c for c in original[len(prefix) :])
        return prefix + laid_out + "".join(symbols)  # what has grown stands at the end
    if kind == "family":
        return replacement.upper() if original.isupper() else "-".join(p[:1].upper() + p[1:] for p in replacement.split("-"))
    if kind == "email" and original.isupper():
        return replacement.upper()
    return replacement


# --------------------------------------------------------------------- Arrow
def _detect(batches):
    for batch in batches:
        rows = {"tkey": [], "kind": [], "value": []}
        ids = []
        keys = batch.column("tkey").to_pylist()
        for at, text in enumerate(batch.column("text")):
            for kind, value in sorted({(k, v) for _, _, k, v in find(text.as_py() or "")}):
                ids.append(at)
                rows["tkey"].append(keys[at])
                rows["kind"].append(kind)
                rows["value"].append(value)
        taken = batch.column("id").take(pa.array(ids, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [taken, pa.array(rows["tkey"], pa.int64()), pa.array(rows["kind"], pa.string()), pa.array(rows["value"], pa.string())],
            names=["id", "tkey", "kind", "value"],
        )


def _candidates(key: bytes, attempt: int):
    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist())
            drawn = [surrogate(key, k, v, attempt) for k, v in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("value"), pa.array(drawn, pa.string())], names=["kind", "value", "surrogate"]
            )

    return run


def _replace(names: list[str]):
    def run(batches):
        for batch in batches:
            texts, counts = [], {k: [] for k in KINDS}
            for text, pairs in zip(batch.column("text").to_pylist(), batch.column("pairs").to_pylist()):
                own = {(p["kind"], p["value"]): p["surrogate"] for p in pairs or ()}
                out, at, n = [], 0, dict.fromkeys(KINDS, 0)
                for a, b, kind, value in find(text) if own else ():
                    out += [text[at:a], render(kind, text[a:b], own[kind, value])]
                    at = b
                    n[kind] += 1
                texts.append(text if not own else "".join(out) + text[at:])
                for k in KINDS:
                    counts[k].append(n[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(texts, pa.string())]
                + [pa.array(counts[k], pa.int64()) for k in KINDS],
                names=[*names, "surrogate_text", *(f"n_{k}" for k in KINDS)],
            )

    return run


# --------------------------------------------------------------------- Spark
def assign_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, value`` (distinct) -> with ``surrogate``: distinct per kind, and no entity of the corpus.

    Given names are permuted among themselves, so they are distinct by construction.
    The others draw until each has a free one; see :func:`surrogate` for formats that run out.
    """
    kinds = "kind string, value string, surrogate string"
    given = entities.where("kind = 'given'").mapInArrow(_candidates(key, 0), kinds)
    pending = entities.where("kind <> 'given'")
    settled = None
    for attempt in count():
        drawn = pending.mapInArrow(_candidates(key, attempt), kinds)
        real = entities.select("kind", F.col("value").alias("surrogate"))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stored(
            free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "pii-won"
        )
        settled = won if settled is None else settled.unionByName(won)
        pending = stored(pending.join(won, ["kind", "value"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return given.unionByName(settled)


def replace_personal_data(
    docs: DataFrame, key: bytes = b"hayloft", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document with its personal data replaced.

    Returns the id, ``surrogate_text`` and the number of replaced mentions of each kind (``n_email`` ...).

    Defined cases: a NULL text stays NULL and an empty one empty, with no
    mentions; text outside the mentions is unchanged; repeated rows are treated
    alike; NULL ids are kept; a very long text is searched whole, in time linear in its
    length; an empty table gives an empty table. Further columns are not carried.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_key(text_col).alias("tkey"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = stored(
        base.select("id", "tkey", "text").mapInArrow(_detect, f"id {id_type}, tkey long, kind string, value string"), "pii-found"
    )
    entities = stored(found.select("kind", "value").distinct(), "pii-entities")
    surrogates = assign_surrogates(entities, key)
    pairs = (
        found.join(surrogates, ["kind", "value"])
        .select(F.struct("id", "tkey").alias("doc"), F.struct("kind", "value", "surrogate").alias("pair"))
        .groupBy("doc")
        .agg(F.collect_set("pair").alias("pairs"))
    )
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return (
        base.withColumn("doc", F.struct("id", "tkey"))
        .join(pairs, "doc", "left")
        .select("id", "text", "pairs")
        .mapInArrow(_replace(["id"]), f"id {id_type}, surrogate_text string, {counts}")
        .withColumnRenamed("id", id_col)
    )
