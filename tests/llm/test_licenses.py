"""Op10: planted wordings, changed wordings, look-alikes."""

import random

from dossier.llm import licenses as L

SCHEMA = "doc_id long, text string, id int, license string, First_Line int"
FILLER = "And thhehaer ertible eslyth lytionsh rerestou esoush atin."


def test_every_wording_is_its_own_license():
    for name in L.LICENSES:
        for w in L.wordings(name):
            assert L.verdict(w)[0] == name, w
            assert L.verdict(f"{FILLER}\n{w.upper()} ")[0] == name, w


def test_changed_words_are_reported():
    usual = L.wordings("Apache-2.0")[-1]
    name, saved, alike, changed = L.verdict(usual.replace("writing", "paper").replace("specific ", ""))
    assert name == "Apache-2.0" and saved > 0.5 and alike > 0.9
    assert sorted(changed) == ["+paper", "-specific", "-writing"]


def test_telling_words_must_agree():
    assert L.verdict("Licensed under the Apache License, Version 1.1.") is None
    assert L.verdict("Licensed under CC BY-NC 3.0.") is None
    assert L.verdict("This work is licensed under the GNU General Public License, version 2.")[0] == "GPL-2.0"
    for text in ("He lost his driver's license and asked for permission.", "No warranty.", "Copyright 2020 the authors",
                 "We redistribute the wealth under the licence of kings and queens"):
        assert L.verdict(text) is None


def test_the_right_dictionary_saves_most():
    for name in ("MIT", "Apache-2.0", "MPL-2.0", "ISC"):
        assert L.ranked(L.wordings(name)[-1])[0][1].name == name


def test_blocks():
    text = "\n".join(["x", "a license", "y", "y", "y", "copyright", *"zzzz", "warranty", "z"])
    assert [(a, b) for a, b, _ in L.blocks(text)] == [(1, 5), (10, 10)]
    assert list(L.blocks("")) == []


def test_table(spark):
    mit = "\n".join([FILLER] * 3 + ["Released under the MIT License."])
    rows = [(1, mit, 1, "", 1), (1, mit, 1, "", 1), (None, mit, 1, "", 1), (2, None, 1, "", 1), (3, "", 1, "", 1),
            (4, FILLER, 1, "", 1), (5, (FILLER + "\n") * 20_000 + "Licensed under CC BY-NC 4.0.", 1, "", 1),
            (6, "Released under the MIT License.\n" + (FILLER + "\n") * 9 + "Licensed under CC BY 4.0.", 1, "", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = L.scanned(docs)
    assert out.columns == ["doc_id", "first_line", "last_line", "license", "saved", "similarity", "n_differences", "differences"]
    got = sorted((r.doc_id or 0, r.first_line, r.license, r.n_differences) for r in out.collect())
    assert got == [(0, 3, "MIT", 0), (1, 3, "MIT", 0), (1, 3, "MIT", 0), (5, 20_000, "CC-BY-NC-4.0", 0), (6, 0, "MIT", 0),
                   (6, 10, "CC-BY-4.0", 0)]
    assert L.scanned(docs.limit(0)).collect() == []


def test_corpus(spark):
    """Every planted notice, and no other document."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    planted = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
               "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    want = sorted((r.doc_id, i, planted[x]) for r in docs.where("text like '%icense%'").collect()
                  for i, x in enumerate(r.text.split("\n")) if x in planted)
    assert len(want) > 200
    assert sorted((r.doc_id, r.first_line, r.license) for r in L.op10_license_scans(spark, sf).collect()) == want


def test_every_wording_passes_the_cues(spark):
    """Each wording alone; a cue may be broken over lines."""
    rows = [(i, w, 1, n, 1) for i, (n, w) in enumerate((n, w) for n in L.LICENSES for w in L.wordings(n))]
    got = {r.doc_id: r.license for r in L.scanned(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {r[0]: r[3] for r in rows}
    assert [(a, b) for a, b, _ in L.blocks("x\nReleased\nunder CC BY 4.0.\nx")] == [(1, 2)]


def test_every_wording_inside_a_long_line():
    rng = random.Random(2)
    syllables = ["er", "lyt", "ion", "thae", "ous", "esh", "at", "in", "re"]
    for name in L.LICENSES:
        for w in L.wordings(name):
            left, right = (" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)) for n in (2500, 2500))
            assert L.verdict(f"{left} {w} {right}")[0] == name, w


def test_several_notices(spark):
    """Next to each other, on one line, far apart on one line, changed beside a decoy; a notice with its cue a line before."""
    two = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0."]
    far = two[0] + " " + (FILLER + " ") * 300 + L.wordings("GPL-2.0")[-1] + " " + (FILLER + " ") * 300 + two[1]
    listed = [f"Licensed under {names[0]}." for names, _ in L.LICENSES.values()]
    decoy = ("Licensed under the Apache License, Version 1.1, or licensed under the newer Apache License, Version 2.0.")
    texts = ["\n".join(two), " ".join(two), far, "; ".join(listed), "\n".join(listed * 2), decoy, "Licensed under\nCC BY 4.0.",
             two[0] + " " + L.wordings("MIT")[-1]]
    want = [["Apache-2.0", "MIT"]] * 2 + [["Apache-2.0", "GPL-2.0", "MIT"], sorted(L.LICENSES), sorted([*L.LICENSES] * 2),
                                          ["Apache-2.0"], ["CC-BY-4.0"], ["MIT", "MIT"]]
    out = L.scanned(spark.createDataFrame([(i, t, 1, "", 1) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert [sorted(r.license for r in out if r.doc_id == i) for i in range(len(texts))] == want
    assert sorted((r.first_line, r.last_line, r.license) for r in out if r.doc_id == 0) == [(0, 0, "MIT"), (1, 1, "Apache-2.0")]
    assert [r.first_line for r in sorted((r for r in out if r.doc_id == 4), key=lambda r: r.first_line)] == [*range(2 * len(listed))]


def test_many_notices_in_bounded_time():
    text = "\n".join(f"part {i}: {w}" for i, w in enumerate([w for n in L.LICENSES for w in L.wordings(n)] * 2))
    assert len(L.notices(text)) >= 650
    same = L.notices("Released under the MIT License.\n" * 2000)
    assert [(a, z, f[2]) for a, z, f in sorted(same)] == [(i, i, "MIT") for i in range(2000)]
