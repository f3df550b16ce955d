"""License scans against every block and template in turn."""

import random

import pytest

from spendlake.llm import licenses

LETTERS = "abcdefghij"


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def words_of(text):
    return [w for w in plain_words(text) if w]


def blocks_of(text, templates, percent):
    words, out = words_of(text), []
    for label, t in templates:
        wanted = words_of(t)
        span = 1
        while span < len(wanted):
            span *= 2
        for start in range(0, len(words), span):
            block = words[start : start + 2 * span]
            shared = len(set(block) & set(wanted))
            if 100 * shared >= percent * len(set(wanted)):
                out.append((label, start, len(block), shared / len(set(wanted))))
    return out


def document(text, templates, percent):
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    held = blocks_of(text, templates, percent)
    base = sorted({x for _, x in places})
    return (
        len(words),
        len(places),
        min(places)[0] if places else None,
        max(places)[0] if places else None,
        ",".join(base),
        ",".join(sorted({*base, *(x[0] for x in held)})),
        1.0 if places else max((x[3] for x in held), default=0.0),
    )


def odd_texts():
    r = random.Random(2)
    texts = [None, "", " \n", "MIT License", "mit-license/MIT License", "the MIT  license. mit LICENSE", "CC-BY cc by cc by"]
    texts += ["Ｍit license", "mité license", "apache License GNU general PUBLIC license", "GNU General Public Licensed"]
    texts += ["mit license " * 4000, "w " * 5000 + "MIT license", "x" * 100_000]
    for _, t in licenses.TEMPLATES:
        words = t.split()
        texts.append("lorem ipsum " * r.randint(0, 70) + t.upper() + " dolor" * r.randint(0, 40))
        texts.append(" ".join(w for w in words if r.random() < 0.85))
        texts.append(" ".join(r.sample(words, len(words))))
        texts.append("\n# ".join(x for w in words for x in (w, "//") if r.random() < 0.9))
    return texts + [" ".join(r.choices(licenses.TEMPLATES[3][1].split(), k=300)) for _ in range(5)]


def table(spark, texts):
    rows = [(i, t, "x", 1, "y", "z") for i, t in enumerate(texts)]
    rows += [(None, "Released under the MIT License.", "", 0, "", ""), (3, texts[3], "x", 1, "y", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, span int, labels string, blocks string"), rows


def test_documents(spark):
    docs, rows = table(spark, odd_texts())
    found = [tuple(r) for r in licenses.licensed_documents(docs.repartition(3)).collect()]
    wanted = [(r[0], *document(r[1], licenses.TEMPLATES, licenses.PERCENT)) for r in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert licenses.licensed_documents(docs.where("false")).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_blocks_of_any_templates(spark, percent):
    r = random.Random(percent)
    templates = [(f"t{i}", " ".join(r.choices(LETTERS, k=k))) for i, k in enumerate((1, 2, 3, 4, 5, 8, 9, 13, 16))]
    templates += [("twice", "a b a b c"), ("t0", "zzz never there")]
    texts = [" ".join(r.choices(LETTERS[: r.randint(1, 10)], k=r.randint(0, 40))) for _ in range(60)]
    docs, rows = table(spark, texts + [None])
    rows_found = licenses.license_blocks(docs, templates, percent).collect()
    wanted = [(x[0], *b) for x in rows for b in blocks_of(x[1], templates, percent)]
    assert sorted(map(tuple, rows_found), key=repr) == sorted(wanted, key=repr)


def test_templates_are_checked(spark):
    with pytest.raises(ValueError, match="no words"):
        licenses.templates_of([("x", " -- ")], 80)
    with pytest.raises(ValueError, match="more than"):
        licenses.templates_of([("x", " ".join(map(str, range(licenses.TEMPLATE_WORDS + 1))))], 80)
