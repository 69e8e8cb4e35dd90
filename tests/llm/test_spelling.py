import re
import zlib
from collections import Counter

import pytest
from pathweave.llm import spelling
from tests.llm.helpers import docs, table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_letters=5, least_count=3, factor=2, one_in=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_letters and c >= least_count}
    near = {w: set() for w in n}
    wild, cut = {}, {}
    for w in n:
        for i in range(len(w)):
            wild.setdefault((i, w[:i], w[i + 1:]), []).append(w)
            cut.setdefault(w[:i] + w[i + 1:], set()).add(w)
    for group in wild.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    for short in n:
        for long in cut.get(short, ()):
            near[short].add(long)
            near[long].add(short)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def run(spark, rows, **more):
    return sorted(map(tuple, spelling.variants(docs(spark, rows), **more).collect()), key=str)


@pytest.mark.parametrize("symbols", [2, 8])
def test_all_documents_against_brute_force(spark, symbols):
    d = table(spark, "documents")
    got = sorted(map(tuple, spelling.variants(d, symbols=symbols).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in d.collect()])
    assert any(r[1] for r in got) and any(r[2] != (r[1] or r[0]) for r in got)


def test_chains_ties_and_letters(spark):
    text = "colour " * 40 + "colours " * 16 + "coloursx " * 7 + "coloursxy " * 3 + "Straße " * 8 + "strasse " * 4 + "straßé " * 2
    text += "étéété " * 12 + "Étéété " * 5 + "abcdef abcdeg " * 6 + "abcdex " * 3 + "x×x÷x " * 4 + "ǆabcdef " * 3
    rows = [(1, text), (2, text.upper())]
    got = run(spark, rows, one_in=0)
    assert got == brute(rows, one_in=0)
    found = {r[0]: r for r in got}
    assert found["coloursxy"][1:3] == ("coloursx", "colour")
    assert found["abcdex"][1] == "abcdef"  # a tie goes to the smaller word


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "abcdefg " * 50), (3, "abcdefh " * 3), (3, "abcdefh " * 3), (4, "longword " * 300_000), (5, "z" * 5_000 + " ") , (6, "1234 ... 漢字")]
    for one_in in (1, 2, 97):
        assert run(spark, rows, one_in=one_in) == brute(rows, one_in=one_in)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "few words")]) == []


def test_many_words_behind_one_reduced_word(spark):
    # with one symbol all words of a length are one reduced word
    words = [a + b + c + "stem" for a in "abcd" for b in "abcdef" for c in "mnopq"]
    rows = [(i, (w + " ") * (3 + i % 11)) for i, w in enumerate(words)]
    assert run(spark, rows, symbols=1) == brute(rows)


def test_other_columns_with_clashing_names(spark):
    rows = [(i, "variant variants variamt", "x", 1, "y", "z") for i in range(5)]
    got = spelling.variants(docs(spark, rows, "word string, n long, near string, reduced string"), one_in=0)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == brute([(r[0], r[1]) for r in rows], one_in=0)


def test_forms_must_be_commoner(spark):
    with pytest.raises(ValueError):
        spelling.variants(docs(spark, [(1, "abcdef")]), factor=1)


def test_neighbourhood_is_full():
    found = spelling.neighbourhood("aba", "ab")
    assert found == {"aba", "ba", "aa", "ab", "bba", "aaa", "abb", "aaba", "baba", "abba", "abab", "abaa"}
