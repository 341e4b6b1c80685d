import random

from frostline.llm import license_scan
from frostline.llm.license_texts import TEMPLATES

SCHEMA = "doc_id long, text string, license string"


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    return sorted((r["doc_id"], r["license"], r["share"]) for r in license_scan.scan(df).collect())


def test_whole_and_edited_templates_at_any_place(spark):
    draw = random.Random(1)
    noise = lambda n: " ".join("".join(draw.choice("abcdefg") for _ in range(6)) for _ in range(n))
    rows, want = [], set()
    for i, (name, text) in enumerate(TEMPLATES.items()):
        for j in range(4):
            words = license_scan.template_words(text)
            if len(words) > 60 and j > 1:  # two words changed: at most ten shingles
                words[len(words) // 3], words[len(words) // 2] = "other", "words"
            rows.append((10 * i + j, f"{noise(j * 7)} {' '.join(words)} {noise(40)}"))
            want.add((10 * i + j, name))
    got = found(spark, rows)
    assert want <= {(d, name) for d, name, _ in got}
    assert all(share >= 0.8 for _, _, share in got)


def test_no_anchor_word_no_match():
    chosen = license_scan.anchors(TEMPLATES)
    for text in TEMPLATES.values():
        words = license_scan.template_words(text)
        shingles = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        assert sum(not any(a in w for w in s for a in chosen) for s in shingles) < 0.8 * len(shingles)


def test_clean_scattered_repeated_and_odd_texts(spark):
    mit = " ".join(license_scan.template_words(TEMPLATES["MIT"]))
    half = mit[: len(mit) // 2]
    rows = [
        (1, "the license of this software is a matter of taste"), (2, half), (3, None), (4, ""), (5, "license"), (6, "released UNDER the MIT license"),
        (7, f"{mit} {'filler ' * 400} {mit}"), (7, f"{mit} {'filler ' * 400} {mit}"), (None, "Released under the MIT License."), (8, "x " * 200_000 + "Released under the MIT License."),
    ]
    got = found(spark, [r for r in rows if r[0] is not None])
    assert [(d, n) for d, n, _ in got] == [(6, "MIT notice"), (7, "MIT"), (7, "MIT"), (8, "MIT notice")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows[-2:-1]], SCHEMA)
    assert [r["doc_id"] for r in license_scan.scan(df).collect()] == [None]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_usual_wordings_and_whole_texts(spark):
    texts = {
        "MIT": "This project is licensed under the MIT License - see the file", "MIT ": "Distributed under the MIT License.", "Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
        "CC-BY-SA-4.0": "under the Creative Commons Attribution-ShareAlike 4.0 International License", "EPL-2.0": "made available under the terms of the Eclipse Public License 2.0",
        "GPL-3.0": TEMPLATES["GPL-3.0 text"], "MPL-2.0": TEMPLATES["MPL-2.0 text"], "Apache-2.0 ": TEMPLATES["Apache-2.0 text"], "CC0-1.0": TEMPLATES["CC0-1.0 text"],
        "BSD-2-Clause": TEMPLATES["BSD-2-Clause"], "BSD disclaimer": TEMPLATES["BSD disclaimer"], "ISC": TEMPLATES["ISC disclaimer"],
    }
    got = found(spark, [(i, f"some words {t} and others") for i, t in enumerate(texts.values())])
    for i, name in enumerate(texts):
        assert any(d == i and license.startswith(name.strip()) for d, license, _ in got), name
