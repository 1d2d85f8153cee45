import hashlib
import re
import zlib

import numpy as np
import pytest
from helpers import frame, prose, seeded

from tripwise.llm import periodic, queries

DDL = "doc_id long, text string, runs string, best int"


def brute_runs(words):
    """(start, length, period) of every run, by definition."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:  # a smaller period has the same stretch
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def best(runs):
    return min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)


def repetitive(rng, n):
    out = []
    while len(out) < n:
        unit = [rng.choice("ab") for _ in range(rng.randint(1, 7))]
        out += unit * rng.randint(1, 9) + unit[:rng.randint(0, len(unit))]
        if rng.random() < 0.3:
            out.append(rng.choice("abc"))
    return out


def test_extensions_equal_brute_force():
    rng = seeded(1)
    texts = [repetitive(rng, rng.randint(0, 120)) for _ in range(30)] + [["a"] * 200, []]
    flat = np.array([ord(w) for t in texts for w in t])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    index = periodic.Extensions(flat, offsets)
    for t, text in enumerate(texts):
        pairs = [(i, j) for i in range(len(text)) for j in range(len(text)) if i != j]
        pairs = [pairs[k] for k in range(0, len(pairs), 7)]
        if not pairs:
            continue
        i, j = np.array(pairs).T
        got = index.lce(i + offsets[t], j + offsets[t])
        for (a, b), x in zip(pairs, got, strict=True):
            want = next((k for k, (u, v) in enumerate(zip(text[a:], text[b:], strict=False)) if u != v), len(text) - max(a, b))
            assert x == want


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed, monkeypatch):
    monkeypatch.setattr(periodic, "GRID_PLACES", [3, 50, 1 << 20][seed % 3])
    rng = seeded(seed)
    texts = [repetitive(rng, rng.randint(0, 150)) for _ in range(120)]
    texts += [["x"] * n for n in (0, 1, 5, 6, 7, 40)] + [list("ab") * k for k in (2, 3, 4, 30)] + [list("abc") * 4, list("abc" * 4)[:-1]]
    codes = np.array([ord(w) for t in texts for w in t])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = periodic.runs_of(codes, offsets)
    want = [(t, *r) for t, text in enumerate(texts) for r in brute_runs(text)]
    assert [tuple(r) for r in got.tolist()] == want and len(want) > 100


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made_up():
    rng = seeded(3)
    rows = [(i, " ".join(repetitive(rng, rng.randint(0, 90))), "", 1) for i in range(200)]
    rows += [(1000 + i, prose(rng, rng.randint(1, 400)), "", 1) for i in range(300)]
    rows += [(5000, None, "", 1), (5001, "", "", 1), (5002, " \t\n ", "", 1), (None, "a a a a a a b", "", 1), rows[3], rows[3],
             (5003, "  é é\u00a0é é é\u00a0é é é\u00a0é é é\u00a0é\x0b\x0cé é\u00a0é é ", "", 1),
             (5004, " ".join(prose(rng, 37) for _ in range(1)) * 1, "", 1), (5005, (prose(rng, 500) + " ") * 41, "", 1)]
    return rows


def test_operator_equals_brute_force(spark, monkeypatch):
    rows = made_up()
    monkeypatch.setattr(periodic, "SLICE_BYTES", 2000)
    found = periodic.find_runs(frame(spark, rows, DDL)).collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], tuple(r.best) if r.best else None, r.collapsed)
                  for r in found), key=str)
    want = []
    for i, text, *_ in rows:
        w = words_of(text)
        runs = brute_runs(w)
        want.append((i, len(w), runs, best(runs), brute_collapsed(w, runs)))
    assert got == sorted(want, key=str)
    assert any(r[2] and r[0] == 5005 for r in want)
    assert periodic.find_runs(frame(spark, [], DDL)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = made_up()
    frame(spark, rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op12_cover_runs"](spark, str(tmp_path)).collect()), key=str)
    want, planted = [], 0
    for i, text, *_ in rows:
        w, h = words_of(text), zlib.crc32(str(i).encode() if i is not None else b"")
        g, n = h // 10, len(words_of(text))
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, planted = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)], planted + 1
        runs = brute_runs(w)
        b = best(runs)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want.append((i, len(runs), *(b or (None,) * 3), 1000 * b[1] // b[2] if b else None,
                     hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()))
    assert got == sorted(want, key=str) and planted > 20
