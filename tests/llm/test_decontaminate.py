import numpy as np
from helpers import edited, frame, prose, seeded

from tripwise.llm import decontaminate as dc

DOCS, ITEMS = "doc_id long, text string, region int, item string", "item_id long, text string, words int"


def local_score(a, b):
    h, best = [[0] * (len(a) + 1) for _ in range(len(b) + 1)], 0
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[j - 1] == b[i - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_full_matrix():
    rng = seeded(1)
    texts = [np.array([rng.randint(2, 6) for _ in range(rng.randint(1, 30))], np.uint64) for _ in range(80)]
    items = [np.array([rng.randint(2, 6) for _ in range(rng.randint(1, 12))], np.uint64) for _ in range(80)]
    score, _ = dc.align(texts, items)
    assert [int(x) for x in score] == [local_score(list(a), list(b)) for a, b in zip(texts, items, strict=True)]


def test_leaks_equal_brute_force(spark):
    rng = seeded(4)
    items = [(i, prose(rng, rng.randint(12, 50)), 0) for i in range(12)]
    docs = []
    for d in range(60):
        text = prose(rng, rng.randint(20, 200))
        if d % 3 == 0:  # exact, edited, cut copies
            t = items[d % 12][1]
            t = [t, edited(rng, t, len(t.split()) // 12), t.upper() + "!"][d // 3 % 3]
            text = prose(rng, 40) + "\n" + t + " " + prose(rng, 30)
        docs.append((d, text, 0, ""))
    docs += [(100, None, 0, ""), (101, "", 0, ""), (None, items[0][1], 0, ""), (None, items[0][1], 0, ""), docs[0],
             (102, "x " * 20000 + items[3][1], 0, "")]
    items += [(50, None, 0), (51, "", 0), items[0], (52, "tiny item", 0)]
    docs.append((103, "a tiny item here", 0, ""))
    got = {(r.doc_id, r.item_id): r.score for r in
           dc.find_leaks(frame(spark, docs, DOCS), frame(spark, items, ITEMS)).collect()}
    forms = lambda t: [w for w in (_form(x) for x in (t or "").lower().split()) if w]
    want = {}
    for d, text, *_ in docs:
        if d == 102:
            want[(102, 3)] = len(forms(items[3][1]))
            continue
        for i, t, _ in items:
            b = forms(t)
            s = local_score(forms(text), b) if b else 0
            if b and (s >= dc.MIN_SHARE * len(b) or s >= dc.MIN_SCORE):
                want[(d, i)] = max(s, want.get((d, i), 0))
    # an alignment without four equal words in a row has no seed
    seedless = {k for k in want if k not in got}
    assert set(got) <= set(want)
    for d, i in seedless:
        a, b = forms(dict((x[0], x[1]) for x in docs)[d]), forms(dict((x[0], x[1]) for x in items)[i])
        grams = {tuple(b[j:j + 4]) for j in range(len(b) - 3)}
        assert not any(tuple(a[j:j + 4]) in grams for j in range(len(a) - 3)), (d, i)
    assert all(got[k] == want[k] for k in got)
    assert {k[0] for k in got} >= {d for d in range(0, 60, 3)}


def _form(x):
    from tripwise.llm.common import word_form

    return word_form(x)


def test_decontaminated_rows(spark):
    rng = seeded(9)
    items = [(1, prose(rng, 30), 0)]
    docs = [(1, prose(rng, 50) + " " + items[0][1], 1, "a"), (2, prose(rng, 60), 2, "b"), (2, prose(rng, 60), 2, "b"),
            (None, None, 3, "c")]
    out = dc.decontaminate(frame(spark, docs, DOCS), frame(spark, items, ITEMS))
    assert out.columns == ["doc_id", "text", "region", "item"]
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 2, 2]
    none = frame(spark, items, ITEMS).filter("false")
    assert dc.decontaminate(frame(spark, docs, DOCS), none).count() == 4
    assert dc.find_leaks(frame(spark, docs, DOCS).filter("false"), frame(spark, items, ITEMS)).count() == 0


def test_edited_short_items_are_aligned_when_a_gram_is_left(spark):
    rng = seeded(21)
    items = [(i, prose(rng, rng.randint(10, 20)), 0) for i in range(30)]
    # exact copies raise the counts of every gram of an item, edited ones lack some
    docs = [(i, prose(rng, 20) + " " + t, 0, "") for i, t, _ in items]
    docs += [(100 * (k + 1) + i, prose(rng, 25) + " " + edited(rng, t, max(1, len(t.split()) * share // 100)) + " "
              + prose(rng, 15), 0, "") for k, share in enumerate((10, 15, 20, 25)) for i, t, _ in items]
    # words 5 and 9 of 12 changed: one seed, in a stretch of four
    one = "ash birch cedar dogwood elm fir gum hazel iris juniper kauri larch".split()
    items.append((70, " ".join(one), 0))
    docs.append((700, " ".join([*one[:4], "x", *one[5:8], "y", *one[9:]]), 0, ""))
    docs.append((701, " ".join(one), 0, ""))
    got = {(r.doc_id, r.item_id): r.score for r in
           dc.find_leaks(frame(spark, docs, DOCS), frame(spark, items, ITEMS)).collect()}
    forms = lambda t: [w for w in (_form(x) for x in t.lower().split()) if w]
    want = {}
    for d, text, *_ in docs:
        a = forms(text)
        grams = {tuple(a[j:j + 4]) for j in range(len(a) - 3)}
        for i, t, _ in items:
            b = forms(t)
            s = local_score(a, b)
            if s >= dc.MIN_SHARE * len(b) and any(tuple(b[j:j + 4]) in grams for j in range(len(b) - 3)):
                want[(d, i)] = s
    assert (700, 70) in want and len(want) > 100
    assert got == want


def test_a_phrase_of_every_item_and_document_is_no_seed(spark):
    rng = seeded(17)
    phrase = "which of the following"
    items = [(i, f"{phrase} {prose(rng, 12)}", 0) for i in range(100)]
    docs = [(i, f"{prose(rng, 30)} {phrase} {prose(rng, 30)}", 0, "") for i in range(100)]
    docs += [(200 + i, f"{prose(rng, 10)} {t}", 0, "") for i, t, _ in items[:10]]
    words = dc.item_words(frame(spark, items, ITEMS))
    seeds = dc.rare_seeds(words)
    of = seeds.groupBy("size", "gram").count()
    assert of.agg({"count": "max"}).first()[0] <= dc.MAX_ITEMS
    assert {r["size"] for r in seeds.select("size").distinct().collect()} == {4, 8}
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(frame(spark, docs, DOCS), frame(spark, items, ITEMS)).collect()}
    assert got == {(200 + i, i) for i in range(10)}
    # copies of one item are all common, and all found
    same = [(i, items[0][1], 0) for i in range(40)]
    got = dc.find_leaks(frame(spark, docs, DOCS), frame(spark, same, ITEMS))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(200, i) for i in range(40)}


def test_items_of_too_few_words_match_nothing(spark):
    docs = [(1, "Yes , it was a long day", 0, "")]
    assert dc.find_leaks(frame(spark, docs, DOCS), frame(spark, [(1, "yes", 0), (2, "it was a", 0)], ITEMS)).count() == 0
    assert dc.find_leaks(frame(spark, docs, DOCS), frame(spark, [(1, "it was a long", 0)], ITEMS)).count() == 1
