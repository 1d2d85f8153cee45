import re

import pyarrow as pa
from helpers import frame, prose, seeded

from tripwise.llm import licenses

DDL = "doc_id long, text string, span string, t int, n_words string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_places(words):
    out = []
    for t in licenses.PHRASES:
        p = t.text.split()
        out += [(i, i + len(p), t.label, True, 1.0) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return sorted(out)


def cut(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        if rng.random() < 0.5:
            w[at] = "zzz"
        else:
            w.insert(at, "yyy")
    return " ".join(w)


def made_up():
    rng = seeded(13)
    bits = ["MIT License", "the Apache  LICENSE.", "GNU General-Public\nLicense", "mit licenses", "general public", "license mit",
            "Mit\u00a0license", "\u212aMIT license", "mit-license mit license"]
    rows = [(i, " ".join(prose(rng, rng.randint(0, 6)) + " " + rng.choice(bits) for _ in range(rng.randint(0, 6))), "", 1, "")
            for i in range(150)]
    rows += [(1000 + i, prose(rng, 40) + " " + cut(rng, t.text, i % 4) + " " + prose(rng, 30), "", 1, "")
             for i, t in enumerate(licenses.NOTICES * 3) if len(t.text) > 100]
    rows += [(2000 + i, prose(rng, 400), "", 1, "") for i in range(50)]
    rows += [(3000, None, "", 1, ""), (3001, "", "", 1, ""), (3002, " .;\t", "", 1, ""), (None, "MIT License", "", 1, ""),
             (None, "MIT License", "", 1, ""), rows[0], rows[0], (3003, "license", "", 1, ""), (3004, (prose(rng, 3000) + " mit license ") * 5, "", 1, "")]
    return rows


def test_words_follow_the_pattern():
    texts = ["", "A-b\u00c4c 1_2", "..", "MIT\x00x\x7fy", "\u00a0 a\u2003b", "Z" * 5000, "end."]
    whole = pa.array(["skip me", *texts], pa.large_string()).slice(1)
    words, offsets = licenses.split_words(whole)
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(offsets, offsets[1:], strict=False)] == [words_of(t) for t in texts]


def test_phrases_equal_brute_force(spark):
    rows = made_up()
    scanned = licenses.scan(frame(spark, rows, DDL))
    key = lambda r: (str(r[0]), str(r))
    got = sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans if s.base]) for r in scanned.collect()), key=key)
    want = sorted(((i, len(words_of(t)), base_places(words_of(t))) for i, t, *_ in rows), key=key)
    assert got == want
    digest = {r.doc_id: r for r in licenses.summary(scanned).collect()}
    for i, t, *_ in rows:
        places, r = base_places(words_of(t)), digest[i]
        assert r.n_base == len(places) and r.first_word == min((p[0] for p in places), default=None)
        assert r.last_word == max((p[0] for p in places), default=None) and 0 <= r.score <= 1
        assert r.base_labels == ",".join(sorted({p[2] for p in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        if places:
            assert r.score == 1.0
    assert licenses.scan(frame(spark, [], DDL)).count() == 0


def test_edited_notices_are_found_where_they_stand(spark):
    rng = seeded(2)
    rows, want = [], {}
    for i, t in enumerate(licenses.NOTICES * 6):
        n = len(licenses.template_words(t))
        edits = i // len(licenses.NOTICES) % 3 if n > 20 else 0
        rows.append((i, prose(rng, 50) + " " + cut(rng, t.text, edits) + " " + prose(rng, 50), "", 1, ""))
        want[i] = (t.label, 50, 50 + n + edits)
    rows += [(1000 + i, prose(rng, 300), "", 1, "") for i in range(40)]
    # half of a notice is none
    rows.append((2000, " ".join(licenses.NOTICES[0].text.split()[:25]), "", 1, ""))
    for r in licenses.scan(frame(spark, rows, DDL)).collect():
        notices = [s for s in r.spans if not s.base]
        if r.doc_id >= 1000:
            assert not notices
            continue
        label, a, b = want[r.doc_id]
        own = [s for s in notices if s.label == label]
        assert len(own) == 1 and own[0].share >= licenses.MIN_SHARE
        assert a <= own[0].start + 0 <= a + 12 and b - 12 <= own[0].end <= b


def test_two_notices_in_one_text_are_two_spans(spark):
    bsd = next(t for t in licenses.NOTICES if t.label == "bsd").text
    spans = licenses.scan(frame(spark, [(1, f"{bsd} x x x {bsd}", "", 1, "")], DDL)).first().spans
    n = len(licenses.template_words(licenses.Template("", bsd)))
    assert [(s.start, s.end, s.label, s.share) for s in spans] == [(0, n, "bsd", 1.0), (n + 3, 2 * n + 3, "bsd", 1.0)]
