import math
import re

from quarry.llm import license_scan as L
from quarry.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows):
    out = []
    for i, t in rows:
        ws = words(t)
        places = sorted((k, label) for p, label in L.PHRASES.items() for k in range(len(ws)) if ws[k:k + len(p.split())] == p.split())
        best, found = 0.0, set()
        for label, names, template in L.TEMPLATES:
            own, span = set(template.split()), L.span_of(template)
            for at in range(0, len(ws), span // 2):
                has = set(ws[at:at + span])
                if len(has & own) >= math.ceil(L.THRESHOLD * len(own) - 1e-9) and set(names.split()) <= has:
                    found.add(label)
                    best = max(best, len(has & own) / len(own))
        out.append((i, len(ws), [k for k, _ in places], sorted({x for _, x in places}), sorted(found), 1.0 if places else best))
    return sorted(out, key=str)


def run(docs):
    return sorted(((r.id, r.n_words, sorted(p.start for p in r.places), list(r.base), sorted(r.found), r.score) for r in L.scan(docs).collect()), key=str)


LONG = L.TEMPLATES[0][2]
CASES = [
    (1, "Released under the MIT License."), (2, "mit\n\nlicense MIT license mit LICENSE"), (3, "The GNU General Public License, version 3"), (4, "mit licenses, amit license"),
    (5, "É mit" + chr(0xA0) + "license mit-license"), (6, LONG), (7, " ".join(LONG.split()[:30])), (8, " ".join(LONG.split()[:20])),
    (9, "\n".join(LONG.split())), (10, "\n\n".join(LONG.split())), (11, "Licensed under CC BY-NC 4.0."), (12, "by nc 4 0"), (13, " ".join(w for _, _, t in L.TEMPLATES for w in t.split())),
    (13, "apache license apache license"), (14, "general public\tlicense"), (15, "mit"), (16, "x" * 50000 + " mit license"),
] + [(100 + k, " ".join(LONG.split()[k::2]) + " of the software " * k) for k in range(10)]


def found(docs):
    return {r.id: (sorted(r.base), sorted(r.found)) for r in L.scan(docs).collect()}


def test_other_licences_and_languages_are_not_mit(make_docs):
    filler = lambda n: " ".join(f"wort{k}" for k in range(n))
    texts = {
        1: "Released under the Apache License", 2: "veröffentlicht mit der Zeit under the license", 3: f"{filler(9)} mit {filler(30)} licensed under the Apache License, version 2.0 {filler(5)}",
        4: f"mit und mit {filler(3)} released under the GNU General Public License, version 3", 5: "released mit the software under a license " * 40,
        6: "licensed under BY NC 4.0", 7: "this program is free software you can redistribute it and or modify it under the terms of the other license as published by the free software foundation"}
    got = found(make_docs(list(texts.items())))
    assert got == {1: (["apache"], []), 2: ([], []), 3: (["apache"], []), 4: (["gpl"], []), 5: ([], []), 6: ([], []), 7: ([], [])}


def test_a_notice_is_found_wherever_it_stands(make_docs):
    """At every place relative to the blocks, and across the border of two chunks; not where its words are scattered."""
    filler = lambda n: " ".join(f"w{k}" for k in range(n))
    docs, want = [], {}
    for t, (label, _, text) in enumerate(L.TEMPLATES):
        for k, n in enumerate([0, 1, 7, 8, 15, 31, 33, 63, 65, L.CHUNK - 5, L.CHUNK - 1, L.CHUNK, 2 * L.CHUNK - 3]):
            docs.append((100 * t + k, f"{filler(n)} {text.upper()}\n\n{filler(20)}"))
            want[100 * t + k] = [label]
        docs.append((100 * t + 99, f" {filler(40)} ".join(text.split())))
        want[100 * t + 99] = []
    assert {i: f for i, (_, f) in found(make_docs(docs)).items()} == want


def test_against_brute_force(make_docs, odd_docs, no_docs):
    assert run(make_docs(CASES)) == brute(CASES)
    assert run(odd_docs) == brute(ODD)
    assert L.scan(no_docs).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_license_scan"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(Eval|Map)", plan)
