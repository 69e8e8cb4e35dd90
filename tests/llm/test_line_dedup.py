import random

import numpy as np

from pathweave.llm import line_dedup
from tests.llm.helpers import docs, table


def shingles(line):
    n = line_dedup.SHINGLE
    line = line.ljust(n, "\0")
    return {line[i:i + n] for i in range(len(line) - n + 1)}


def brute(rows):
    """Kept text of every row: all pairs of distinct lines by exact similarity, the first place of a component stays."""
    order = lambda d: (d is not None, d or 0)
    places = {}
    for d, t in sorted(set(rows), key=lambda r: order(r[0])):
        for n, line in enumerate((t or "").split("\n")):
            if line_dedup.normalised(line):
                places.setdefault(line_dedup.normalised(line), []).append((order(d), n))
    keys = list(places)
    sets = [shingles(k) for k in keys]
    label = {k: k for k in keys}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(keys)):
        for j in range(i):
            if len(sets[i]) >= 0.8 * len(sets[j]) and len(sets[j]) >= 0.8 * len(sets[i]):
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                    label[root(keys[i])] = root(keys[j])
    first = {}
    for k in keys:
        first[root(k)] = min([*places[k], *([first[root(k)]] if root(k) in first else [])])
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        norm = [line_dedup.normalised(x) for x in lines]
        kept = [x for n, (x, k) in enumerate(zip(lines, norm)) if not k or first[root(k)] == (order(d), n)]
        out.append((d, "\n".join(kept), sum(map(bool, norm)), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_fuzzy_lines_odd_texts_and_other_columns(spark):
    random.seed(8)
    base = [" ".join(random.choice("alpha beta gamma delta rho sigma tau phi chi psi".split()) + str(random.randrange(90)) for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(50):
        lines = []
        for line in random.sample(base, 3):
            words = line.split()
            if i % 3:
                words[random.randrange(30)] = "changed"
            lines.append(("  " if i % 2 else "") + " ".join(words).upper() if i % 5 == 0 else " ".join(words))
        rows.append((i, "\n".join(lines) + ("\n\n" if i % 4 == 0 else "")))
    rows += [(90, None), (91, ""), (92, "\n \n"), (93, "short"), (94, "Short \nshort\nshor"), (None, "no id\nshort"), (95, "L" * 100_000 + "\n" + "m n " * 20_000), (97, "twice\nin one"), (97, "twice\nin one")]
    df = docs(spark, [(*r, 7, ["t"]) for r in rows], "n_lines int, tags array<string>")
    got = line_dedup.dedup(df)
    assert set(got.columns) == {"doc_id", "text", "tags", "n_chars", "n_lines", "n_removed"}
    result = got.collect()
    assert all(r.tags == ["t"] and r.n_chars == len(r.text) for r in result)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in result), key=str) == brute(rows)
    assert line_dedup.dedup(docs(spark, [])).collect() == []


def test_documents(spark):
    df = table(spark, "documents").select("doc_id", "text")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup(df).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sum(a != b for a, b in zip(got, want)) <= 0.01 * len(want)


def test_banding_finds_similar_lines():
    random.seed(9)
    hit = n = 0
    for size in (30, 80, 300, 2000):
        for _ in range(150):
            a = "".join(random.choice("abcdefghij ") for _ in range(size))
            at = random.randrange(size - 5)
            b = a[:at] + "".join(random.choice("klmno") for _ in range(max(1, size // 60))) + a[at + max(1, size // 60):]
            x, y = shingles(a), shingles(b)
            if len(x & y) >= 0.8 * len(x | y):
                s = line_dedup.signatures([a, b])
                n += 1
                hit += bool((s[0] == s[1]).any())
    assert n > 200 and hit / n > 0.97
    assert line_dedup.signatures(["a", "a", "b"]).shape == (3, line_dedup.BANDS)
    assert (np.diff(line_dedup.signatures(["a", "a"]).astype(np.float64), axis=0) == 0).all()


def test_short_lists_are_hashed_together_and_give_the_same_links(monkeypatch):
    random.seed(8)
    lists = []
    for _ in range(60):
        words = [f"w{random.randrange(500)}" for _ in range(random.randrange(1, 40))]
        lists.append([" ".join("other" if random.random() < 0.03 else w for w in words) for _ in range(random.choice([1, 2, 2, 2, 3, 7, 30]))])
    lists.append(["long " * 40_000, "long " * 39_000])
    want, calls, hashed = [line_dedup.similar_edges(x) for x in lists], [], line_dedup.shingle_hashes
    assert sum(len(u) for u, _ in want) > 20
    monkeypatch.setattr(line_dedup, "shingle_hashes", lambda lines: calls.append(1) or hashed(lines))
    assert [(list(u), list(v)) for u, v in line_dedup._edges(lists)] == [(list(u), list(v)) for u, v in want]
    assert len(calls) < len(lists) // 2


def test_lines_of_a_text_are_normalised_at_once():
    texts = ["", "\n", " A  b \nc\td\n", "x\r\ny", "É  Σ \naΣ\xa0b Σ\n　İ", "a\x1cb\x85c", "plain\n two  blanks \n\n"]
    assert [line_dedup.normalised_lines(t) for t in texts] == [[line_dedup.normalised(x) for x in t.split("\n")] for t in texts]


def test_signatures_stay_in_the_cache(monkeypatch):
    """Pieces are small, and a line's signature does not depend on its piece."""
    lines = [f"line {i} " + "ab é"[i % 4] * (i % 90) for i in range(4000)]
    want, sizes, signed = line_dedup._signatures(lines), [], line_dedup._signatures
    monkeypatch.setattr(line_dedup, "_signatures", lambda piece: sizes.append(sum(map(len, piece))) or signed(piece))
    assert (line_dedup.signatures(lines) == want).all()
    assert max(sizes) <= 1 << 15
