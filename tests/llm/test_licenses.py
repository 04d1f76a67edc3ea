"""License scans against regular expressions and plain loops."""

import random
import re

import pytest

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import licenses
from llm_fixtures import documents, package_for_workers  # noqa: F401

SCANNER = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)


def plain_words(text):
    ascii_lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower)


def plain_places(text, phrases=licenses.PHRASES, templates=licenses.TEMPLATES):
    words = plain_words(text)
    found = []
    for phrase, label in phrases.items():
        own = phrase.split()
        found += [(label, True, at, at + len(own)) for at in range(len(words)) if words[at:at + len(own)] == own]
    for label, template in templates.items():
        pattern = re.compile(licenses.template_pattern(template))
        for at in range(len(words)):
            # The longest passage from here: the longest prefix that matches as a whole.
            for end in range(min(len(words), at + 200), at, -1):
                if pattern.fullmatch("".join(word + " " for word in words[at:end])):
                    found.append((label, False, at, end))
                    break
    return len(words), sorted(found, key=lambda place: (place[2], place[3], place[0]))


def renderings(template, rng):
    """A text that the template should accept, with random choices and case."""
    out, skipping, depth = [], 0, 0
    for k, part in enumerate(re.split(r"<<([^>]*)>>", template)):
        if k % 2 and part == "beginOptional":
            depth += 1
            skipping = skipping or (depth if rng.random() < 0.5 else 0)
        elif k % 2 and part == "endOptional":
            skipping = 0 if skipping == depth else skipping
            depth -= 1
        elif not skipping and k % 2 and (found := re.search(r'words="(\d+)-(\d+)"', part)):
            out.append(" ".join(rng.choices(["my", "own", "Thing"], k=rng.randint(*map(int, found.groups())))))
        elif not skipping and k % 2:
            out.append(rng.choice(re.search('match="([^"]*)"', part)[1].split("|")))
        elif not skipping:
            out.append(part)
    text = " ".join(out)
    return text.upper() if rng.random() < 0.3 else text


@pytest.mark.parametrize("label", licenses.TEMPLATES)
def test_mandatory_wording_has_to_match_exactly(label):
    rng = random.Random(label)
    for _ in range(6):
        text = renderings(licenses.TEMPLATES[label], rng)
        whole = f"Some lead-in. {text}\n\nand what follows"
        assert SCANNER.scan(whole) == plain_places(whole)
        n, places = SCANNER.scan(text)
        assert (label, False, 0, n) in places
        # Without any one of its mandatory words it is another text.
        words = text.split()
        for at in [k for k, word in enumerate(words) if len(word) > 6][:3]:
            broken = " ".join(words[:at] + ["other"] + words[at + 1:])
            assert SCANNER.scan(broken) == plain_places(broken)


def test_regions_nest_and_replace():
    templates = {"a": 'one <<beginOptional>>two <<beginOptional>>three<<endOptional>> four<<endOptional>> <<var;words="0-2">> end',
                 "b": 'go <<var;match="x y|x">> y'}
    scanner = licenses.Scanner({}, templates)
    rng = random.Random(4)
    for _ in range(500):
        text = " ".join(rng.choices(["one", "two", "three", "four", "end", "go", "x", "y"], k=rng.randint(1, 12)))
        assert scanner.scan(text) == plain_places(text, {}, templates)
    for wrong in ("<<beginOptional>>a<<endOptional>>", '<<var;words="1-2">> a', "a <<beginOptional>> b", "a <<var;name>>"):
        with pytest.raises(ValueError):
            licenses.compile_template(wrong)


def test_rows_equal_plain_search(documents):
    rows = [*EDGE_ROWS, (20, "MIT License mit license, MIT-LICENSE"), (21, "the apache\nlicense (general public license)"),
            (22, "commit license summit licenses"), (23, "Released under the MIT License. " * 500)]
    docs = documents(*rows)
    found = licenses.scan_licenses(docs, ["doc_id", "text", "n_words", "id"]).toDF("doc", "text", "extra", "more", "n_words", "places")
    seen = 0
    for row in found.collect():
        seen += 1
        assert row["extra"] == -1 and row["more"] == "extra"
        places = [(p["label"], p["phrase"], p["start"], p["end"]) for p in row["places"]]
        if row["text"] and len(row["text"]) < 30_000:
            assert (row["n_words"], places) == plain_places(row["text"])
        elif not row["text"]:
            assert row["n_words"] == 0 and not places
    assert seen == len(rows)
