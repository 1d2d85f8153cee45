import numpy as np
from helpers import edited, frame, prose, seeded

from tripwise.llm import near_dup as nd

DDL = "doc_id long, text string, node string, bucket int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_banded_alignment_decides_as_the_full_matrix():
    rng = seeded(3)
    left, right = [], []
    for _ in range(150):
        a = [rng.randint(1, 40) for _ in range(rng.randint(0, 50))]
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 3))):
            if b and rng.random() < 0.5:
                b[rng.randrange(len(b))] = rng.randint(1, 40)
            elif b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(1, 40))
        left.append(np.array(a, np.uint64))
        right.append(np.array(b, np.uint64))
    got = nd.edit_distances(left, right, 0.8)
    for a, b, d in zip(left, right, got, strict=True):
        true, limit = distance(list(a), list(b)), int(0.2 * max(len(a), len(b)) + 1e-9)
        assert true <= d <= limit if true <= limit else d == -1


def brute_classes(texts):
    """Class of each distinct text: components of word edit similarity 0.8 or more."""
    keys = list(dict.fromkeys(texts))
    words = [[w for w in (nd_form(x) for x in k.lower().split()) if w] for k in keys]
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            longer = max(len(words[i]), len(words[j]))
            if longer and distance(words[i], words[j]) <= 0.2 * longer + 1e-9:
                root[find(i)] = find(j)
    return {k: find(i) for i, k in enumerate(keys)}


def nd_form(x):
    from tripwise.llm.common import word_form

    return word_form(x)


def rows_of(seed=5):
    rng = seeded(seed)
    rows, at = [], 0
    shared = prose(rng, 30)
    for _ in range(6):
        base = prose(rng, rng.randint(60, 120))
        for _ in range(5):  # copies and near copies
            rows.append((at, edited(rng, base, rng.randint(0, 4)) if rng.random() < 0.7 else base, "n", 1))
            at += 1
    for _ in range(6):  # a shared passage is no copy
        rows.append((at, prose(rng, 120) + " " + shared, "n", 1))
        at += 1
    big = prose(rng, 80)
    for _ in range(40):  # a large group
        rows.append((at, edited(rng, big, 2), "n", 1))
        at += 1
    return rows


def test_classes_equal_brute_force(spark):
    rows = rows_of()
    rows += [(900, None, "n", 1), (901, "", "n", 1), (902, "  \n", "n", 1), (903, "one two", "n", 1), (904, "One, two.", "n", 1),
             (None, rows[0][1], "n", 1), rows[1], (905, "word " * 3000, "n", 1)]
    got = nd.classes(frame(spark, rows, DDL)).toPandas()
    assert len(got) == len(rows)
    truth = brute_classes([r[1] or "" for r in rows])
    ids = {}
    for r in rows:
        if r[0] is not None:
            ids.setdefault(truth[r[1] or ""], []).append(r[0])
    by_id = dict(zip(got.doc_id, got.class_id, strict=True))
    for r in rows:
        if r[0] is not None:
            assert by_id[r[0]] == min(ids[truth[r[1] or ""]]), r
    assert by_id[903] == by_id[904] == 903


def test_representatives_and_empty(spark):
    rows = rows_of(8)
    rows += [rows[0], (None, "alone here now", "n", 1), (None, "alone here now", "n", 1)]
    docs = frame(spark, rows, DDL)
    got = nd.representatives(docs).toPandas()
    truth = brute_classes([r[1] for r in rows])
    assert len(got) == len(set(truth.values()))
    assert list(got.columns) == ["doc_id", "text", "node", "bucket"]
    assert nd.classes(docs.filter("false")).count() == 0
    assert nd.representatives(docs.filter("false")).count() == 0


def test_chained_links_across_leaders(spark):
    """Texts linked only through a third text are one class."""
    rng = seeded(2)
    base = prose(rng, 100).split()
    a, b, c = list(base), list(base), list(base)
    for i in range(0, 18):
        a[i] = f"aa{i}"
    for i in range(80, 98):
        c[i] = f"cc{i}"
    got = nd.classes(frame(spark, [(1, " ".join(a), "", 0), (2, " ".join(b), "", 0), (3, " ".join(c), "", 0)], DDL))
    assert {r["class_id"] for r in got.collect()} == {1}


def test_cells_give_the_links_that_join_components(spark, monkeypatch):
    """Cells of few rows join what one cell joins; the bound never drops a near pair."""
    rng = seeded(7)
    texts = [prose(rng, 60) for _ in range(3)]
    texts = [edited(rng, texts[i % 3], rng.randint(0, 14)) for i in range(30)]
    words = [np.array([hash(w) & 0xFFFFFFFF for w in t.split()], np.uint64) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    hist, n = nd.histograms(np.concatenate(words), offsets), np.diff(offsets).astype(float)
    ok = nd.possible_pairs(hist, hist, n, n, 0.8)
    near = {(i, j) for i in range(30) for j in range(i) if distance(list(words[i]), list(words[j])) <= 0.2 * max(n[i], n[j]) + 1e-9}
    assert all(ok[i, j] for i, j in near)
    # all share the bucket of band 1; the even ones share that of band 0 as well, so they pair up there
    comp = [i % 3 * 4 + i // 3 % 4 for i in range(30)]
    rows = [(1, 1, bytes([i]), bytes([comp[i]]), int(n[i]), [i % 2 * (i + 1), 9], words[i].astype(np.int64).tolist()) for i in range(30)]
    rows += [(0, 0, *r[2:]) for r in rows if r[2][0] % 2 == 0]
    members = spark.createDataFrame(rows, "bucket long, band int, node binary, comp binary, n_words int, keys array<long>, words array<long>")

    def merged(pairs):
        root = list(range(12))
        for i, j in pairs:
            a, b = root[comp[i]], root[comp[j]]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    want = merged(p for p in near if comp[p[0]] != comp[p[1]])
    assert 1 < len(set(want)) < 12
    for cell, size in ((4, 1 << 20), (1000, 1 << 20), (1000, 300)):
        monkeypatch.setattr(nd, "CELL_ROWS", cell)
        monkeypatch.setattr(nd, "CELL_WORDS", size)
        got = [(r.b[0], r.a[0]) for r in nd.links_across(members, 0.8).collect()]
        assert all((max(p), min(p)) in near and comp[p[0]] != comp[p[1]] for p in got)
        assert merged(got) == want


def test_linked_is_a_spanning_forest():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1000, 60).astype(np.uint64)
    words = [base.copy() for _ in range(40)] + [rng.integers(0, 1000, 60).astype(np.uint64) for _ in range(5)]
    for k in range(40):
        words[k][rng.integers(0, 60, 3)] = 5000 + k
    i, j = np.triu_indices(45, 1)
    links = nd.linked((i, j), np.arange(45), words, 0.8)
    assert len(links) == 39 and len({x for p in links for x in p}) == 40
    assert nd.linked((i[:0], j[:0]), np.arange(45), words, 0.8) == []


def test_representatives_keep_columns_of_any_name(spark):
    rows = [(1, "a b c d e f g", 7, "k", 0.5, b"z", 3), (2, "a b c d e f g", 8, "l", 0.5, b"z", 3), (3, "other words here now", 9, "m", 0.5, b"z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_node int, keep_id string, keep_node double, whole_row binary, `a.b` int")
    assert sorted(map(tuple, nd.representatives(docs).collect())) == [tuple(rows[0]), tuple(rows[2])]


def test_recall_at_the_limit():
    """Pairs of long texts with every fifth word replaced, or a fifth of them anywhere, share a key."""
    rng = np.random.default_rng(31)
    for size in (51, 60, 120, 200, 400):
        for spaced in (False, True):
            left = [rng.integers(1, 1 << 62, size).astype(np.uint64) for _ in range(300)]
            right = [t.copy() for t in left]
            for t in right:
                at = rng.integers(5) + 5 * np.arange(size // 5) if spaced else rng.choice(size, size // 5, replace=False)
                at = at[at < size]
                t[at] = rng.integers(1, 1 << 62, len(at)).astype(np.uint64)
            ends = np.arange(301) * size
            a, b = (nd.text_keys(np.concatenate(t), ends) for t in (left, right))
            met = ((a == b) & (a != nd._MAX)).any(1).mean()
            assert met >= (0.9 if spaced else 0.95), (size, spaced, met)


def test_recall_by_edit_rate(spark):
    """Isolated pairs with scattered substitutions: of tiny texts all are found, of others nearly all."""
    rng = seeded(31)
    rows, pairs, at = [], {}, 0
    for size, share, n in [(5, 20, 30), (6, 17, 30), (7, 15, 30), (9, 12, 30), (12, 17, 60), (20, 10, 60), (20, 20, 60),
                           (30, 20, 60), (48, 20, 60), (50, 15, 60), (60, 12, 60), (60, 20, 60), (150, 10, 60), (150, 15, 60), (150, 20, 60)]:
        for _ in range(n):
            base = [f"w{rng.randrange(10 ** 9)}" for _ in range(size)]
            other = list(base)
            for x in rng.sample(range(size), max(1, size * share // 100)):
                other[x] = f"v{rng.randrange(10 ** 9)}"
            rows += [(at, " ".join(base), "n", 1), (at + 1, " ".join(other), "n", 1)]
            pairs.setdefault((size, share), []).append(at)
            at += 2
    # a word less, at the border of the kinds of keys
    for size in (5, 6, 9, 10, 41, 42, 50, 51, 52):
        base = [f"w{rng.randrange(10 ** 9)}" for _ in range(size)]
        rows += [(at, " ".join(base), "n", 1), (at + 1, " ".join(base[:2] + base[3:]), "n", 1)]
        pairs[(size, 0)] = [at]
        at += 2
    of = {r.doc_id: r.class_id for r in nd.classes(frame(spark, rows, DDL)).collect()}
    recall = {k: sum(of[i] == of[i + 1] for i in own) / len(own) for k, own in pairs.items()}
    print(recall)
    assert all(r == 1 for (size, share), r in recall.items() if size < 10 or not share), recall
    assert min(recall.values()) >= 0.95, recall
    assert len(set(of.values())) >= len(rows) / 2
