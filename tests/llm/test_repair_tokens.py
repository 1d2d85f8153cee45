import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from helpers import frame, prose, seeded

from tripwise.llm import repair_tokens as rt

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", " \n", "  a  b \n c   ", " x", "a ", "\n\n a\t b  c   ", "日本 語 text", "it's we'll  I'm 12 3a",
       "<|endoftext|> a <|endoftext|>b", "a b \x1c c", "É́e x²1", "word " * 5000, "a" * 30000]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_pieces_encode_as_whole_texts(reference):
    rng, coder = seeded(1), rt.Encoder(PATH)
    texts = ODD + [prose(rng, 50).replace(" ", rng.choice([" ", "  ", "\n"]), 5) for _ in range(20)]
    for t in texts:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == reference(t), t[:40]


@pytest.mark.parametrize("ids", [[], [2], [7] * 999, [1, 2] * 500, list(range(3000))])
def test_round_trip_and_random_access(ids):
    a = np.array(ids, np.uint32)
    shard = rt.Shard(rt.pack_shard(a))
    assert (shard.ids(0, len(a)) == a).all()
    rng = seeded(2)
    for _ in range(30):
        s = rng.randint(0, len(a))
        n = rng.randint(0, len(a) - s)
        assert (shard.ids(s, n) == a[s:s + n]).all()


def test_frequent_pairs_are_replaced():
    a = np.random.default_rng(0).zipf(1.4, 60_000).clip(0, 900).astype(np.uint32)
    seq, rules, first = rt.repair(a)
    assert len(seq) < 0.8 * len(a) and len(rules)
    flat, start, length = rt.expansions(rules, first)
    back = np.concatenate([flat[start[s - first]:start[s - first] + length[s - first]] if s >= first else [s] for s in seq])
    assert (back == a).all()


def test_written_shards(spark, reference):
    rng = seeded(3)
    rows = [(i, prose(rng, rng.randint(1, 200)), "x", 5) for i in range(60)] + [(100 + i, t, "x", 5) for i, t in enumerate(ODD)]
    rows += [(70, None, "x", 5), (71, "same", "x", 5), (71, "same", "x", 5), (None, "no id", "x", 5)]
    rng.shuffle(rows)
    docs = frame(spark, rows, "doc_id long, text string, part string, start int").repartition(3)
    shards = rt.write_tokens(docs, PATH, shard_ids=2000)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.ids_crc32) for r in rt.read_tokens(shards).collect())
    want, at = [], 0
    for d, t, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(reference(t or "") + [2], "<u4")
        want.append((-1 if d is None else d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == sorted(want)
    assert rt.read_tokens(rt.write_tokens(docs.filter("false"), PATH)).count() == 0


def test_a_word_with_marks_uses_the_ids_of_its_letters(reference):
    coder, asked = rt.Encoder(PATH), []

    class Counted:
        def tokenize(self, shown, model=coder.model):
            asked.append(shown)
            return model.tokenize(shown)

    coder.model = Counted()
    text = "on vermilion, vermilion. vermilion (vermilion) vermilion\n"
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference(text)
    assert len([x for x in asked if x.endswith("vermilion") and x[0] == coder.blank]) <= 2  # after a blank, with the line end


@pytest.mark.parametrize("text", ["a\n b", "a \t b", "\t b", "x 　 y", "x  y", "a b\n", "a b ", " a", "  ", "a,\n", "it's' dog's, 'tis",
                                  "x_ y$, z<| w", "a\n\n b c\x1c d", "é, è. ñ!", "a b\n\n c", "3, 4. x4,"])
def test_white_space_and_marks(reference, text):
    coder = rt.Encoder(PATH)
    for _ in range(2):  # pieces met for the first time, and known ones
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference(text)


def test_the_distinct_words_of_many_texts_are_encoded_in_few_calls(reference, monkeypatch):
    coder, calls = rt.Encoder(PATH), []

    class Counted:
        def encode_batch_fast(self, shown, words=coder.words, **options):
            calls.append([w for x in shown for w in x.split(" ")])
            return words.encode_batch_fast(shown, **options)

    monkeypatch.setattr(rt, "CALL_WORDS", 50)
    coder.words = Counted()
    rng = seeded(5)
    texts = ODD + [" ".join(f"w{rng.choice('aeiouéß')}x{'y' * rng.randint(0, 9)}" + rng.choice(["", "", ",", ".\nEnd", "7 "])
                            for _ in range(rng.randint(1, 300))) for _ in range(40)]
    for _ in range(2):  # pieces met for the first time, and known ones
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(pa.array(texts, pa.large_string()))]
        assert got == [reference(t) for t in texts]
    met = [w for c in calls for w in c if w]
    assert len(met) == len(set(met)) and max(map(len, calls)) <= 51  # each once; the blank behind a call's last word
    assert len(calls) < 20


def test_pieces_met_once_are_forgotten(reference, monkeypatch):
    monkeypatch.setattr(rt, "CACHE_PIECES", 300)
    coder, sizes = rt.Encoder(PATH), []
    for n in range(20):
        texts = [f"the same words, and nr{chr(97 + n)}{'x' * i} é{'y' * i}.\nof {'z' * i}\n it" for i in range(20)]
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(pa.array(texts, pa.large_string()))]
        assert got == [reference(t) for t in texts]
        sizes.append(len(coder.codes))
        assert len(coder.pool) == coder.length.sum() and max(coder.codes.values()) < len(coder.length) == len(coder.start)
    assert max(sizes) < 500 and "words," in coder.codes


def test_slices_without_texts_or_words():
    coder = rt.Encoder(PATH)
    assert list(coder.encode_all(pa.array([], pa.large_string()))) == []
    assert list(coder.encode_all(pa.array(["", ""], pa.large_string()))) == [b"", b""]


def test_shifted_slices_of_texts(reference):
    texts = pa.array(["not this one", "a  b \n", "", "x y,\n", "last one"], pa.large_string())
    got = [np.frombuffer(x, "<u4").tolist() for x in rt.Encoder(PATH).encode_all(texts.slice(1, 3))]
    assert got == [reference(t) for t in texts.slice(1, 3).to_pylist()]


def test_random_texts(reference):
    rng, coder = seeded(6), rt.Encoder(PATH)
    signs = "  \n\t'sx,.A3éß ́日<|\x00\x1c­_"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(pa.array(texts, pa.large_string()))]
    assert [t for t, g in zip(texts, got, strict=True) if g != reference(t)] == []


def test_new_pieces_take_no_python_call_each(reference):
    coder, calls = rt.Encoder(PATH), []
    text = " ".join(f"w{'aeiou'[i % 5]}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)},{i}é{chr(97 + i % 23)}'s" for i in range(4000))
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        got = coder.encode(text)
    finally:
        sys.setprofile(None)
    assert np.frombuffer(got, "<u4").tolist() == reference(text)
    assert len(calls) < 2000


def test_pretokens_are_those_of_the_pattern():
    rng, coder = seeded(7), rt.Encoder(PATH)
    signs = "  \n''strevldmST,.!A3é²×ªß¼¿"
    texts = ["", " ", "\n", "'", "é", "it's's 'll''ve"] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(8000)]
    words, counts = coder._pretokens(pa.array(["no", *texts], pa.large_string()).slice(1))
    want = [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    assert counts.tolist() == list(map(len, want)) and words.to_pylist() == [x for w in want for x in w]


def test_expansions_of_nested_rules():
    rules = np.array([[1, 2], [10, 10], [3, 11], [12, 10], [4, 4]], np.uint32)
    flat, start, length = rt.expansions(rules, 10)
    assert [flat[s:s + n].tolist() for s, n in zip(start, length, strict=True)] == [
        [1, 2], [1, 2, 1, 2], [3, 1, 2, 1, 2], [3, 1, 2, 1, 2, 1, 2], [4, 4]]
    with pytest.raises(ValueError):
        rt.expansions(np.array([[11, 1], [10, 1]], np.uint32), 10)


def test_each_new_word_is_encoded_once(reference):
    coder, met = rt.Encoder(PATH), []

    class Counted:
        def encode_batch_fast(self, shown, words=coder.words, **options):
            met.extend(w for x in shown for w in x.split(chr(255))[:-1])
            return words.encode_batch_fast(shown, **options)

    coder.words = Counted()
    texts = [" ".join(f"w{'aeiouéß'[i * n % 7]}{'y' * (i % 9)}" + ["", ",", ".\nEnd"][i % 3] for i in range(90)) for n in range(1, 9)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(pa.array(texts, pa.large_string()))]
        assert got == [reference(t) for t in texts]
    assert len(met) == len(set(met)) > 50 and coder.blank + "wa" in met
