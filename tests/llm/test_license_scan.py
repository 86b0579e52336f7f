import llm_texts as texts
from hayloft.llm import license_scan as scan

PHRASES = [(p.split(), label) for p, label in scan.PHRASES]


def brute_base(text):
    ws = texts.ALNUM.findall(texts.lower(text))
    return len(ws), sorted((i, label) for p, label in PHRASES for i in range(len(ws)) if ws[i : i + len(p)] == p)


def brute_best(text):
    """Best share of a template's 3-grams in any stretch of words, by plain search over stretches.

    Whether matches belong together is decided by walking from one to the next:
    two belong together if their diagonals are at most ``SHIFT`` apart.
    """
    ws, best = texts.ALNUM.findall(texts.lower(text)), {}
    for label, template in scan.TEMPLATES:
        ts = template.split()
        hits = [(i, j) for i in range(len(ws) - 2) for j in range(len(ts) - 2) if ws[i : i + 3] == ts[j : j + 3]]
        while hits:
            together, todo = set(), [hits[0]]
            while todo:
                at = todo.pop()
                if at not in together:
                    together.add(at)
                    todo += [h for h in hits if h not in together and abs((h[0] - h[1]) - (at[0] - at[1])) <= scan.SHIFT]
            hits = [h for h in hits if h not in together]
            for first in {i for i, _ in together}:
                within = {j for i, j in together if first <= i and i + 3 - first <= len(ts) * scan.MAX_STRETCH + scan.SHIFT}
                best[label] = max(best.get(label, 0), len(within) / (len(ts) - 2))
    return best


MIT = scan.TEMPLATES[1][1]


def rows():
    words = MIT.split()
    return texts.document_rows(3) + [
        (300, "x Released under the MIT License. y", "en", "s", 0),
        (301, "Mit-License, apache\nLICENSE; GNU General Public License general public license", "en", "s", 0),
        (302, f"intro {MIT.upper()} end", "en", "s", 0),
        (303, " ".join(words[:10] + ["really"] + words[10:]), "en", "s", 0),  # a word put in: two diagonals
        (304, " ".join(words[:9]), "en", "s", 0),  # too little of it
        (305, "Licensed under CC BY-NC 4.0. " * 50, "en", "s", 0),  # repeated lines
        (306, " ".join(reversed(words)), "en", "s", 0),
        (307, "licensed under cc " * 4 + "licensed under cc by sa 4 0", "en", "s", 0),  # pieces before a whole notice
        (308, " ".join(words[:10] + ["a"] + words[10:15] + ["b"] * 3 + words[15:22] + ["c"] * 3 + words[22:]), "en", "s", 0),
    ]


def test_matches_brute_force(spark):
    data = rows()
    df = texts.with_clashing_columns(spark.createDataFrame(data, texts.SCHEMA)).repartition(4)
    got = scan.scan_licenses(df).collect()
    expected = []
    for doc_id, text, *_ in data:
        n, places = brute_base(text)
        best = brute_best(text)
        labels = {label for _, label in places} | {label for label, c in best.items() if c >= scan.MIN_COVERAGE}
        score = 1.0 if places else max(best.values(), default=0.0)
        expected.append((doc_id, n, places, sorted(labels), round(score, 9)))
    assert sorted(
        ((r.doc_id, r.n_words, sorted(tuple(p) for p in r.base_places), r.labels, round(r.score, 9)) for r in got), key=str
    ) == sorted(expected, key=str)


def test_labels_of_known_cases(spark):
    by = {r.doc_id: r for r in scan.scan_licenses(spark.createDataFrame(rows(), texts.SCHEMA)).collect()}
    assert by[302].labels == by[303].labels == ["mit"] and not by[302].base_places
    assert by[304].labels == [] and 0 < by[304].score < scan.MIN_COVERAGE
    assert by[305].labels == ["cc-by-nc"] and len(by[305].spans) >= 50
    assert by[307].labels == ["cc-by-sa"] and by[307].score == 1.0
    assert [(x.start, x.end) for x in by[307].spans if x.coverage == 1.0] == [(12, 19)]
    assert by[308].labels == ["mit"]


def test_a_long_text_keeps_its_notices(spark):
    """Over one MiB, a notice at its end and the beginning of one over and over."""
    text = "some words in between " * 50_000 + "Licensed under CC. " * 2000 + MIT
    got = scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert got.labels == ["mit"] and got.n_words == len(texts.ALNUM.findall(text))
    assert by[301].labels == ["apache", "gpl", "mit"]


def test_empty_table(spark):
    assert scan.scan_licenses(spark.createDataFrame([], texts.SCHEMA)).collect() == []
