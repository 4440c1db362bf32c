"""Line and substring dedup against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import line_dedup as L
from quarry.llm import substring_dedup as S
from quarry.llm.common import text_key
from tests.llm.conftest import ODD


def brute(docs, runs, cut, spare_first):
    """docs: (id, key, text) in order of first occurrence; the texts without covered units.

    ``runs(text)``: (key, place, length) of each run; ``cut(text, places)``: the text without them.
    """
    first, later = {}, []
    for i, k, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1])):
        for key, pos, n in sorted(runs(t or ""), key=lambda x: x[1]):
            if first.setdefault(key, (i, k, pos)) != (i, k, pos):
                later.append((i, k, key, pos, n))
    gone = defaultdict(set)
    for i, k, key, pos, n in later:
        f = first[key]
        spare = range(f[2], f[2] + n) if spare_first and f[:2] == (i, k) else ()
        gone[i, k] |= {u for u in range(pos, pos + n) if u not in spare}
    return sorted([(i, t and cut(t, gone[i, k])) for i, k, t in docs], key=str)


def line_cut(text, gone):
    at = L.line_offsets(text)
    return "".join(text[at[u]:at[u + 1]] for u in range(len(at) - 1) if u not in gone)


def plain_units(text):
    """Sentences and their cuts, word by word: (start, end, words) in characters."""
    wide = "".join(f"{chr(a)}-{chr(b)}" for a, b in S.UNSPACED)
    words = list(re.finditer(f"[{wide}]|[^\\s{wide}]+", text))
    sentences = []
    for k, w in enumerate(words):
        upto = text[:w.start()]
        bare = upto.rstrip()
        gap, said = upto[len(bare):], bare.rstrip(S.CLOSING)
        if not k or "\n" in gap or said.endswith(tuple(S.WIDE_STOPS)) or gap and said.endswith(tuple(S.STOPS)):
            sentences.append([])
        sentences[-1].append(w)
    starts = []
    for sentence in sentences:
        cuts = {0}
        if len(sentence) > S.UNIT_WORDS:
            h = [hashed(w[0]) for w in sentence]
            keys = [None] + [int(S.mixed(np.array([(a * S._BASES[1] + b) % 2**64], np.uint64))[0]) for a, b in zip(h, h[1:])]
            for k in range(1, len(keys) - S.CUT_WORDS + 1):
                window = range(k, k + S.CUT_WORDS)
                cuts.add(max(window, key=lambda j: (-keys[j], j)))
            nth = {}
            for j in range(1, len(keys)):
                nth[j] = nth[j - 1] + 1 if j > 1 and keys[j] == keys[j - 1] else 0
            cuts = {c for c in cuts if not c or nth[c] % S.CUT_WORDS == 0}
        starts += [(sentence[c].start(), [w[0] for w in sentence[c:e]]) for c, e in zip(sorted(cuts), [*sorted(cuts)[1:], None])]
    at = [0, *[a for a, _ in starts[1:]], len(text)]
    return [(a, b, ws) for (_, ws), a, b in zip(starts, at, at[1:])] if starts else []


def hashed(word):
    return int(S.segmented([word]).words[0])


def plain_runs(min_words):
    def runs(text):
        units = plain_units(text)
        spans = set()
        for i in range(len(units)):
            fits = [j for j in range(i + 2, len(units) + 1) if sum(len(u[2]) for u in units[i:j]) >= min_words]
            spans |= {(i, j) for j in fits[:1]}
        for j in range(len(units) + 1):
            fits = [i for i in range(j - 1) if sum(len(u[2]) for u in units[i:j]) >= min_words]
            spans |= {(i, j) for i in fits[-1:]}
        return [(tuple(w for u in units[i:j] for w in u[2]), units[i][0], units[j - 1][1] - units[i][0]) for i, j in spans]

    return runs


def char_cut(text, gone):
    return "".join(c for k, c in enumerate(text) if k not in gone)


def keyed(docs, id_col="doc_id"):
    return [tuple(r) for r in docs.select(id_col, text_key(docs.text), "text").collect()]


def corpus(seed):
    rng = random.Random(seed)
    passage = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randint(5, 25))) + "." for _ in range(4)]
    docs = []
    for i in range(60):
        own = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 40))) + rng.choice([".", "!", "", "?"]) for _ in range(rng.randint(0, 6))]
        if i % 3 == 0:
            at = rng.randint(0, len(own))
            own[at:at] = passage[rng.randint(0, 1):rng.randint(2, 4)] * rng.randint(1, 2)
        docs.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n"]).join(own)))
    return docs + docs[:5]


def line_runs(text):
    return list(zip(*L.line_windows(text), strict=True))


SHORT = [t if len(t or "") < 3000 else t[:3000] for _, t in ODD]


def check(docs, op, want, **how):
    out = op.deduplicated(docs, **how)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


@pytest.mark.parametrize("rows", [ODD, corpus(1), corpus(2)])
def test_lines_against_brute_force(make_docs, rows):
    docs = make_docs(rows)
    check(docs, L, brute(keyed(docs), line_runs, line_cut, True))


@pytest.mark.parametrize("rows", [[(i, t) for (i, _), t in zip(ODD, SHORT)], corpus(1), corpus(2)])
@pytest.mark.parametrize("min_words", [2, 13, 20])
def test_sentences_against_brute_force(make_docs, rows, min_words):
    docs = make_docs(rows)
    check(docs, S, brute(keyed(docs), plain_runs(min_words), char_cut, False), min_words=min_words)


def test_very_long_texts(odd_docs):
    got = sorted(((r.id, len(r.text or ""), r.n_removed) for r in S.substring_dedup(odd_docs).collect()), key=str)
    long = {(i, n) for i, n, _ in got if (n or 0) > 1000}
    assert (10, 100000) in long and len(got) == len(ODD)
    assert sum(n for i, n, _ in got if i in (9, 11)) < 150000  # the same words again and again


@pytest.mark.parametrize("op", [L, S])
def test_empty_table(no_docs, op):
    assert op.deduplicated(no_docs).count() == 0


def test_a_long_passage_goes_everywhere_but_once(make_docs):
    words = " ".join(f"p{k}" for k in range(55)) + "."  # one sentence
    docs = make_docs([(i, f"Own {i} start here. {words} And own {i} end.") for i in range(5)] + [(99, "A clean text. It stays as it is, with no repeats at all, however long it may get in the end.")])
    got = {r.id: (r.text, r.spans, r.payload.text) for r in S.substring_dedup(docs).collect()}
    assert words in got[0][0] and not got[0][1] and not got[99][1]
    for i in range(1, 5):
        assert got[i][0] == f"Own {i} start here. And own {i} end."
        (span,) = got[i][1]
        assert got[i][2][span.start:span.end].strip() == words


def test_lines_first_occurrence_stays_whole(make_docs):
    docs = make_docs([(1, "a\nb\nc\nd\n"), (2, "x\na\nb\nc\ny"), (3, "same\n" * 9), (4, "a\nb\nz")])
    got = {r.doc_id: r.text for r in L.deduplicated(docs).collect()}
    assert got == {1: "a\nb\nc\nd\n", 2: "x\ny", 3: "same\n" * 3, 4: "a\nb\nz"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\t' é", max_size=300))
def test_lines_join_to_the_text(text):
    at = L.line_offsets(text)
    assert at[0] == 0 and at[-1] == len(text) and all(a < b for a, b in zip(at, at[1:]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n\t'」 é。日本語ไ\u3000\x1f", max_size=120), max_size=5), st.sampled_from([2, 5, 20]))
def test_units_and_runs_as_word_by_word(texts, min_words):
    u = S.segmented(texts)
    plain = [plain_units(t) for t in texts]
    assert list(zip(u.text.tolist(), u.start.tolist(), u.end.tolist(), np.diff(u.word).tolist())) == [(k, a, b, len(ws)) for k, units in enumerate(plain) for a, b, ws in units]
    first, behind = S.runs_of(u, min_words)
    got = sorted(zip(u.text[first].tolist(), u.start[first].tolist(), (u.end[behind - 1] - u.start[first]).tolist()))
    assert got == sorted((k, p, n) for k, t in enumerate(texts) for _, p, n in plain_runs(min_words)(t))


def keys_of(text, min_words=S.MIN_WORDS):
    u = S.segmented([text])
    first, behind = S.runs_of(u, min_words)
    return set(S.spans_hash(u.words, S._BASES[1], u.word[first], u.word[behind]).tolist())


def test_text_without_spaces(make_docs):
    """A Chinese passage of 1,500 characters, with full-width stops, and one without any stop."""
    rng = random.Random(8)
    new = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    passage = "".join(new(rng.randint(5, 30)) + "。" for _ in range(80))
    flat = new(300)
    docs = make_docs([(i, f"{new(40)}。{passage}{new(33)}。{new(i)}，{flat}{new(25)}。") for i in range(4)] + [(9, new(500))])
    got = {r.id: r for r in S.substring_dedup(docs).collect()}
    assert not got[0].spans and not got[9].spans
    for i in (1, 2, 3):
        assert passage not in got[i].text and passage[40:-40] not in got[i].text
        assert flat[40:-40] not in got[i].text and len(got[i].text) < 40 + 33 + i + 25 + 150


def test_short_runs_are_a_parameter(make_docs):
    """Four sentences of 13 words in all, in three documents."""
    passage = "One two three. Four five six. Seven eight nine. Ten eleven twelve thirteen."
    docs = make_docs([(i, f"Own text {i} comes here. {passage} And so on {i}.") for i in range(3)])
    assert [r.n_removed for r in S.substring_dedup(docs).collect()] == [0, 0, 0]
    got = {r.id: r.text for r in S.substring_dedup(docs, min_words=13).collect()}
    assert got[0].count("One two") == 1 and all(got[i] == f"Own text {i} comes here. And so on {i}." for i in (1, 2))


def test_a_passage_inside_sentences_is_found_at_every_offset(make_docs):
    words = " ".join(f"p{k}" for k in range(55))  # no full stop
    host = lambda i, n: " ".join(f"own{i}x{k}" for k in range(n))
    docs = make_docs([(i, f"Start {i} here. {host(i, i)}, {words} {host(-i, 20 - i)}.") for i in range(1, 18)])
    got = {r.id: r for r in S.substring_dedup(docs).collect()}
    assert not got[1].spans
    for i in range(2, 18):
        (span,) = got[i].spans
        cut = got[i].payload.text[span.start:span.end].split()
        assert len(cut) >= S.MIN_WORDS and set(cut) <= set(words.split())
        assert host(i, i) + "," in got[i].text and host(-i, 20 - i) in got[i].text


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.integers(0, 40), min_size=4, max_size=4))
def test_a_passage_of_55_words_has_a_common_run(seed, sides):
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    passage = new(55)
    one, two = (keys_of(" ".join(new(a) + passage + new(b))) for a, b in (sides[:2], sides[2:]))
    assert one & two


def test_one_line_paragraphs_with_blank_lines_between(make_docs):
    docs = make_docs([(1, "one\n\ntwo\n\nthree\n\nfour\n"), (2, "own\n\none\n\n\n \ntwo\n\nthree\n\nfour\n\nend"), (3, "one\n\ntwo\n\nmine\n"),
                      (4, "u\n\nv\n\nw\n\nu\nv\nw\n\n\nz\n"), (5, "same\n\n" * 5), (6, "own 6\n\none\n\ntwo\n\nthree\n\nu\nv\nw\n\nlast")])
    got = {r.id: r for r in L.line_dedup(docs).collect()}
    assert {i: r.text for i, r in got.items()} == {
        1: "one\n\ntwo\n\nthree\n\nfour\n", 2: "own\n\n\nend", 3: "one\n\ntwo\n\nmine\n",
        4: "u\n\nv\n\nw\n\n\n\nz\n", 5: "same\n\n" * 3, 6: "own 6\n\n\nlast"}
    assert got[2].n_removed == 9 and len(got[6].spans) == 1


def test_queries(spark):
    from quarry.llm.queries import QUERIES
    from tests.llm.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    old = {r.doc_id: r.text for r in docs.collect()}
    for name, want in (("op1_substring_dedup", brute(keyed(docs), plain_runs(S.MIN_WORDS), char_cut, False)), ("op10_line_dedup", brute(keyed(docs), line_runs, line_cut, True))):
        rows = QUERIES[name](spark, SF).collect()
        assert sorted(((r.doc_id, r.text) for r in rows), key=str) == want
        for r in rows:
            t = old[r.doc_id]
            assert r.changed == (r.n_removed > 0) == bool(r.spans) == (r.text != t)
            assert char_cut(t, {k for a, b in r.spans for k in range(a, b)}) == r.text
