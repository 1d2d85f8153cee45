import hashlib

import pytest
from helpers import frame, prose, seeded

from tripwise.llm import mixing, sharding

DDL = "doc_id long, text string, source string, slot string, turn int, prefix string"


def rows_of(n=300, seed=1):
    rng = seeded(seed)
    return [(i, prose(rng, rng.randint(1, 60)), "hot" if i % 3 == 0 else f"s{i % 7}", "x", 1, "p") for i in range(n)]


EXTRA = [(1000, None, "hot", "x", 1, "p"), (1001, "", "hot", "x", 1, "p"), (1002, "no source", None, "x", 1, "p"),
         (1003, "w " * 5000, "s1", "x", 1, "p"), (None, "null id", "s1", "x", 1, "p"), (None, "null id", "s1", "x", 1, "p"),
         (5, "other text, same id", "s1", "x", 1, "p")]


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1}, {f"s{i}": i + 1 for i in range(40)},
                                     {"a": 0.999, "b": 0.0005, "c": 0.0005}])
def test_pfair_deviation_is_below_one_block(weights):
    q, parts = mixing.quotas(weights)
    assert sum(parts.values()) == q and min(parts.values()) >= 1
    slots = mixing.pfair_period(q, parts)
    assert sorted(t for s in slots.values() for t in s) == list(range(q))
    for s, own in slots.items():
        have, taken = 0, set(own)
        for t in range(q):
            have += t in taken
            assert abs(have - parts[s] * (t + 1) / q) < 1, (s, t)


def brute_edf(q, parts):
    """Slot by slot: of the released blocks that with the earliest deadline."""
    done, out = {s: 0 for s in parts}, []
    for t in range(q):
        ready = [(-(-(done[s] + 1) * q // a), s) for s, a in parts.items() if done[s] < a and done[s] * q // a <= t]
        _, s = min(ready)
        out.append(s)
        done[s] += 1
    return out


def test_period_equals_brute_force():
    q, parts = mixing.quotas({"a": 3, "b": 2, "c": 7, "d": 0.4}, period=64)
    slots = mixing.pfair_period(q, parts)
    assert [next(s for s in slots if t in slots[s]) for t in range(q)] == brute_edf(q, parts)


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"a": 0.7, "b": 0.2999, "c": 0.0001}])
def test_deviation_from_the_given_weights_at_many_periods(weights):
    q, parts = mixing.exact_quotas(weights)
    total, n = sum(weights.values()), 40_000
    have = dict.fromkeys(weights, 0)
    for t, (s, i, slot) in enumerate(mixing.pfair(q, parts, dict.fromkeys(weights, n))):
        if t == n:
            break
        assert (slot, i) == (t, have[s])
        have[s] += 1
        assert all(abs(have[x] - weights[x] / total * (t + 1)) < 1 + 1e-6 for x in weights), t


def test_mix_keeps_exact_shares_over_many_slots(spark):
    # thirds of 1024 parts are a block off after three periods
    rows = [(i, "x" * 10, "abc"[i % 3], "x", 1, "p") for i in range(15_000)]
    docs = frame(spark, rows, DDL)
    for weights in (None, {"a": 1, "b": 1, "c": 1}):
        got = mixing.mix(docs, weights=weights, block_bytes=10).select("slot", "source", "exact_mix").toPandas()
        assert got.exact_mix.all() and sorted(got.slot) == list(range(15_000))
        got = got.sort_values("slot")
        for s in "abc":
            assert ((got.source == s).cumsum() - (got.slot + 1) / 3).abs().max() < 1, s
    # a row of no text after the last full block
    tail = frame(spark, [*rows[:30], *((100 + i, "", "a", "x", 1, "p") for i in range(20))], DDL)
    assert mixing.mix(tail, block_bytes=10).count() == 50


def test_mix_places_every_row(spark):
    rows = rows_of() + EXTRA
    docs = frame(spark, rows, DDL)
    got = mixing.mix(docs, block_bytes=500, chunk_rows=16, period=64).toPandas()
    assert len(got) == len(rows)
    assert set(got.columns) == {"doc_id", "text", "source", "turn", "prefix", "block", "slot", "slot_bytes", "exact_mix"}
    got["source"] = got.source.fillna("-")
    assert (got.groupby("slot").source.nunique() == 1).all()
    # the bytes of a source follow one another
    for _, g in got.groupby("source"):
        spans = sorted((b * 500 + s, len((t or "").encode())) for b, s, t in zip(g.block, g.slot_bytes, g.text, strict=True))
        at = 0
        for start, n in sorted(spans, key=lambda x: (x[0], x[1])):
            assert start <= at
            at = max(at, start + n)
        assert at == sum(n for _, n in spans)
    given = mixing.mix(docs, weights={"hot": 1, None: 1, "unused": 5, **{f"s{i}": 2 for i in range(7)}}, block_bytes=500)
    assert given.count() == len(rows) and given.filter("NOT exact_mix").count() > 0
    ordered = mixing.in_mix_order(given).collect()
    keys = [(r.slot, r.slot_bytes) for r in ordered]
    assert keys == sorted(keys)
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"hot": 1})
    assert mixing.mix(docs.filter("false")).count() == 0


def brute_shards(rows, limit):
    """Split any bucket over the limit that holds several hashes on its next bit."""
    keyed = []
    for d, t, *_ in rows:
        ident = f"{'' if d is None else d}:{t or ''}"
        keyed.append((int(hashlib.md5(ident.encode()).hexdigest()[:15], 16), len((t or "").encode())))
    out = {}

    def place(prefix, own):
        if sum(b for _, b in own) <= limit or len({h for h, _ in own}) == 1:
            for h, _ in own:
                out[h] = prefix
            return
        bit = 59 - len(prefix)
        for b in (0, 1):
            half = [x for x in own if x[0] >> bit & 1 == b]
            if half:
                place(prefix + str(b), half)

    place("", keyed)
    return [out[h] for h, _ in keyed]


@pytest.mark.parametrize("limit", [100, 1500, 10**9])
def test_shards_equal_brute_force(spark, limit):
    rows = rows_of() + EXTRA + [(7000, "same " * 30, "s", "x", 1, "p")] * 40
    got = sharding.shard(frame(spark, rows, DDL), limit).toPandas()
    assert len(got) == len(rows)
    want = sorted((r[0] or -1, r[1] or "", s) for r, s in zip(rows, brute_shards(rows, limit), strict=True))
    assert sorted(zip(got.doc_id.fillna(-1).replace(0, -1), got.text.fillna(""), got.shard_id, strict=True)) == [
        (-1 if d == 0 else d, t, s) for d, t, s in want]
    sizes = got.groupby(["shard_id", "overflow"]).sh_bytes.agg(["sum", "count"])
    assert ((sizes["sum"] <= limit) | (sizes["count"] == 1)).all()


def test_empty_and_written_shards(spark, tmp_path):
    docs = frame(spark, rows_of(50), DDL)
    assert sharding.shard(docs.filter("false"), 100).count() == 0
    sharding.write_shards(docs, str(tmp_path / "s"), 2000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.select("shard").distinct().count() > 1


def test_tempered_targets_differ_from_the_shares_and_are_met(spark):
    rows = [(i, "x" * 10, "a" if i % 10 < 7 else "b" if i % 10 < 9 else "c", "x", 1, "p") for i in range(1000)]
    got = mixing.mix(frame(spark, rows, DDL), block_bytes=10, temperature=0.7).toPandas().sort_values("slot")
    assert len(got) == 1000 and got.slot.is_unique
    weight = {s: round(1000 * n ** 0.7) for s, n in {"a": 700, "b": 200, "c": 100}.items()}
    total = sum(weight.values())
    exact = got[got.exact_mix]
    assert 0.05 < abs(weight["a"] / total - 0.7) and 200 < len(exact) < 1000
    for s, w in weight.items():
        assert ((exact.source == s).cumsum() - (exact.slot + 1) * w / total).abs().max() < 1, s
