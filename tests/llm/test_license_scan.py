import re

import numpy as np
import pytest

from feedlake.llm import license_scan, queries

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
PHRASES = {tuple(p.split()): label for p, label in license_scan.PHRASES.items()}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(doc_id, text, templates=license_scan.TEMPLATES, threshold=0.9):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))
    places = [
        (i, label) for i in range(len(words)) for p, label in PHRASES.items()
        if tuple(words[i : i + len(p)]) == p
    ]
    labels, share = set(), 0.0
    for begin in range(0, max(1, -(-len(words) // 64) - 1) * 64, 64):
        block = set(words[begin : begin + 128])
        for label, said in templates:
            wanted = set(license_scan.template_words(said))
            there = len(wanted & block)
            if there * 1000 >= round(threshold * 1000) * len(wanted):
                labels.add(label)
                share = max(share, there / len(wanted))
    base = {label for _, label in places}
    at = [i for i, _ in places] or [None]
    return (
        doc_id, len(words), len(places), at[0], at[-1], ",".join(sorted(base)),
        ",".join(sorted(base | labels)), 1.0 if places else share,
    )


def scanned(spark, rows, **options):
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS key", "2 AS said", "3 AS words", "4 AS Labels"
    )
    found = license_scan.scan(table.repartition(3), **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def test_phrases_and_awkward_texts(spark):
    texts = [
        None, "", " \n", "-- !", "x", "cc by", "CC-BY cc by cc\nby", "cc by ", "cc byx", "xcc by",
        " cc by", "All rights reserved. General Public License, all RIGHTS reserved",
        "K cc by İ", "éCC BY", "general public general public license", "cc\x00by\x7fz",
        "a\U0001f600cc by", "9 cc by 9", "ALL RIGHTS\tRESERVED\n" * 40, "rights reserved all",
        "public license", "cc by " * 300, "w " * 5000 + "cc by" + " w" * 5000,
    ]
    rows = list(enumerate(texts)) + [(None, texts[5]), (None, None), (5, texts[5]), (5, texts[6])]
    assert scanned(spark, rows) == sorted((by_hand(*row) for row in rows), key=repr)


def test_templates_in_long_and_changed_texts(spark):
    rule = np.random.default_rng(4)
    common = ["the", "of", "license", "software", "and", "this", "to", "x", "y", "z", "4", "under"]
    rows = []
    for i in range(400):
        n = int(rule.choice([0, 3, 60, 130, 500, 3000]))
        words = [str(w) for w in rule.choice(common, n)]
        for _ in range(int(rule.integers(0, 4))):
            _, said = license_scan.TEMPLATES[rule.integers(len(license_scan.TEMPLATES))]
            said = said.split()
            for _ in range(int(rule.integers(0, 4))):
                said[rule.integers(len(said))] = str(rule.choice(common))
            at = int(rule.integers(0, len(words) + 1))
            words[at:at] = said
        rows.append((i, " ".join(words)))
    expected = sorted((by_hand(*row) for row in rows), key=repr)
    assert scanned(spark, rows) == expected
    assert {label for row in expected for label in row[6].split(",")} >= {
        label for label, _ in license_scan.TEMPLATES
    }


@pytest.mark.parametrize("threshold", [0.5, 0.75, 1.0])
def test_any_threshold(spark, threshold):
    rule = np.random.default_rng(5)
    templates = [("one", "a b c d e f g"), ("two", "e f g h"), ("three", "k"), ("four", "a c k l m n o p q r")]
    rows = [(i, " ".join(rule.choice(list("abcdefghklmnopqrxyz"), rule.integers(0, 12)))) for i in range(500)]
    found = scanned(spark, rows, templates=templates, threshold=threshold)
    assert found == sorted((by_hand(*row, templates, threshold) for row in rows), key=repr)


def test_every_template_is_found_once_it_stands(spark):
    rows = [(i, f"Some words.\n{said.upper()}.\nMore.") for i, (_, said) in enumerate(license_scan.TEMPLATES)]
    rows += [(100 + i, " ".join(said.split()[::-1][: len(said.split()) * 3 // 4])) for i, (_, said) in enumerate(license_scan.TEMPLATES)]
    found = {row[0]: row for row in scanned(spark, rows)}
    for i, (label, _) in enumerate(license_scan.TEMPLATES):
        assert label in found[i][6].split(",")
        assert found[i][7] == 1.0


def test_empty_table(spark, tmp_path):
    assert scanned(spark, []) == []


def test_query_has_no_python_workers(spark, sf_dir):
    plan = queries.op12_license_scan(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_too_long_templates_are_refused(spark):
    table = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="64 words"):
        license_scan.scan(table, templates=[("long", "a " * 65)])
