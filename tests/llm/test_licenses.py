import random

import pytest

from sitecharge.llm.licenses import TEMPLATES, Scanner, license_findings

FILLER = "some prose that says nothing at all about it and goes on for a while "


@pytest.fixture(scope="module")
def scanner():
    return Scanner(TEMPLATES)


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_every_template_is_found_where_it_stands(scanner, name, text):
    whole = FILLER * 3 + text + " " + FILLER
    found = list(scanner.scan(whole))
    assert [f[0] for f in found] == [name]
    _, first, last, saved, differences = found[0]
    assert whole[first:last].strip(".,:") == text.strip(".,:") and saved > 0 and differences == ""


def test_small_changes_are_reported(scanner):
    text = FILLER + "This work is licensed under the terms of the GNU General Public License, version 3. " + FILLER
    ((name, _, _, _, differences),) = scanner.scan(text)
    assert name == "GPL-3.0" and differences in ("+terms +of +the", "+the +terms +of")


@pytest.mark.parametrize("text", ["", "My driver's license expired in the license office.", "licensed " * 300, FILLER * 50])
def test_other_text_is_left_alone(scanner, text):
    assert list(scanner.scan(text)) == []


def test_table(messy, messy_documents, scanner):
    found = sorted(map(tuple, license_findings(messy_documents).collect()), key=repr)
    plain = [(i, *f) for i, t, *_ in messy for f in scanner.scan(t or "")]
    assert found == sorted(plain, key=repr) and any(f[1] == "MIT" for f in found)
    assert license_findings(messy_documents.limit(0)).count() == 0


def test_several_statements_of_a_long_text(scanner):
    text = (FILLER * 400).join(["", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", ""])
    assert [f[0] for f in scanner.scan(text)] == ["CC-BY-4.0", "CC-BY-SA-4.0"]


def test_templates_bring_their_own_cues():
    scanner = Scanner([("Own-1.0", "Everyone may copy these pages for teaching.")])
    assert [f[0] for f in scanner.scan(FILLER + "Everyone may copy\nthese pages for teaching. " + FILLER)] == ["Own-1.0"]
    with pytest.raises(ValueError):
        Scanner([("None", " . ")])


def plain_ranking(scanner, words, at):
    """Of all templates, in order of savings around word ``at``: (license, first, last, whether confirmed)."""
    import zstandard

    def size(text, dictionary=None):
        used = dictionary and zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=used).compress(text.encode()))

    out = []
    for i, (name, template, _, names) in enumerate(scanner.templates):
        own = " ".join(template)
        low = max(0, at - 3 * len(template) // 2)
        block = words[low : at + 3 * len(template) // 2]
        saved = size(" ".join(block)) - size(" ".join(block), own)
        share, first, last, differences = scanner._wording(template, block)
        confirmed = share >= 0.8 and first <= at - low < last and scanner._same(names, block, first, last, differences)
        if saved > 0:
            out.append((-saved, i, name, low + first, low + last, confirmed))
    return [entry[2:] for entry in sorted(out)]


def test_the_ranking_decides(scanner):
    """Statements at random places, some changed: what is found is the first confirmed one of the plain ranking over all templates."""
    r = random.Random(12)
    fill = FILLER.split()
    found = 0
    for _ in range(60):
        name, statement = r.choice(TEMPLATES)
        words = statement.split()
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = r.choice(fill)
        text = " ".join(r.choices(fill, k=r.randint(0, 40)) + words + r.choices(fill, k=r.randint(0, 40)))
        plain = [w.strip(".,:;!?()[]\"'") for w in text.lower().split()]
        for at in range(len(plain)):
            ranking = plain_ranking(scanner, plain, at)
            first = next((entry[:3] for entry in ranking if entry[3]), None)
            best = scanner.best(plain, at) if plain[at] in scanner.cues else None
            if plain[at] in scanner.cues:
                assert (best and best[:3]) == first
                found += first is not None
    assert found > 40


def test_two_or_three_clauses_are_not_told_apart(scanner):
    text = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ((name, *_),) = scanner.scan(f"{FILLER}{text} 1. {FILLER}")
    assert name == "LicenseRef-BSD-2-or-3-Clause"


def test_line_break_in_a_cue(scanner):
    text = FILLER + "This work is dedicated to the public\ndomain under CC0 1.0 Universal. " + FILLER
    assert [f[0] for f in scanner.scan(text)] == ["CC0-1.0"]


@pytest.mark.parametrize(
    "text",
    [
        "Licensed under the Artistic License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 4.",
        "This work is licensed under the GNU Library General Public License, version 2.",
        "Released under the BSD 2-Clause License.",
        "This work is not licensed under the GNU General Public License, version 3.",
    ],
)
def test_other_names_and_versions_are_other_licenses(scanner, text):
    assert list(scanner.scan(FILLER + text + " " + FILLER)) == []


def test_versions_are_numbers(scanner):
    text = FILLER + "This work is licensed under the GNU General Public License, version 3.0. " + FILLER
    assert [(f[0], f[4]) for f in scanner.scan(text)] == [("GPL-3.0", "-3")]


@pytest.mark.parametrize("expression", ["MIT", "Apache-2.0 OR MIT", "(GPL-2.0+ WITH Classpath-exception-2.0)"])
def test_identifiers(scanner, expression):
    text = f"{FILLER}\n// SPDX-License-Identifier: {expression}\n{FILLER}All rights reserved. {FILLER}"
    (mark, rights) = scanner.scan(text)
    assert mark[0] == expression and text[mark[1] : mark[2]] == f"SPDX-License-Identifier: {expression}"
    assert rights[0] == "LicenseRef-All-Rights-Reserved" and text[rights[1] : rights[2]] == "All rights reserved."


@pytest.mark.parametrize("text, name", [("CC BY 4.0", "CC-BY-4.0"), ("CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"), ("CC-BY-SA-3.0", "CC-BY-SA-3.0")])
def test_short_names(scanner, text, name):
    whole = FILLER + text + ". " + FILLER
    ((found, first, last, _, _),) = scanner.scan(whole)
    assert found == name and whole[first:last] == text


def test_every_template_that_saves_is_compared():
    r = random.Random(8)
    words = [f"w{r.randint(0, 10**6)}" for _ in range(60)]
    chunks = [" ".join(words[i : i + 3]) for i in range(0, 60, 3)]
    decoys = [(f"decoy{i}", " ".join(r.sample(chunks, len(chunks)))) for i in range(8)]
    text = f"{' '.join(words[:30])} Released under the MIT License. {' '.join(words[30:])}"
    assert [f[0] for f in Scanner([*decoys, ("MIT", "Released under the MIT License.")]).scan(text)] == ["MIT"]
