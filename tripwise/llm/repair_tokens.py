"""Token ids in grammar-compressed binary shards.

Documents in ascending id order are encoded with a public tokenizer and cut into
shards of bounded size.  Each shard is compressed by Re-Pair: the frequent pairs of
neighbouring ids are replaced by new nonterminals, again and again, until no pair is
frequent, in at most ``ROUNDS`` rounds.  The shard keeps its rules and every symbol's expansion length, so any range
of ids is decoded without the ids before it.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import ranges, text_slices, written

END_ID = 2
#: Ids of a shard, occurrences a pair needs, and rounds of replacement at most.
SHARD_IDS, MIN_PAIRS, ROUNDS = 1 << 20, 24, 12
#: Of a round's pairs those at least this share as frequent as the most frequent are replaced.
ROUND_SHARE = 1 / 8
#: Encoded pieces a worker keeps from slice to slice, and words in a call of the library.
CACHE_PIECES, CALL_WORDS = 500_000, 20_000
#: Words that the library encodes as one string.
LOT_WORDS = 64
#: A slice's text: the pieces kept are indexed anew for each slice.
ENCODE_BYTES = 18 << 20
#: So many words are not worth a call for all.
FEW_WORDS = 16
#: Symbols between two stored places of a shard.
STRIDE = 1024
_MAGIC, _HEAD = b"RPG2", "<QIIIB"
_COUNT_BITS = 19


# --- Re-Pair -------------------------------------------------------------------------------
def _frequent_pairs(seq: np.ndarray, least: int, share: float, odd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, numbers, pairs): where pairs of at least ``least`` occurrences, and ``share`` of the most frequent
    one's, begin, and which of ``pairs`` each is.

    Pairs are counted by a hash; of the pairs of one hash value that occurs often the
    last one stands for it and is counted by itself, the others wait for a later
    round, whose multiplier is another one.
    """
    a, b = seq[:-1], seq[1:]
    h = a * np.uint32(0x9E3779B1 + 2 * odd)
    h ^= b * np.uint32(0x85EBCA6B + 4 * odd)
    h >>= np.uint32(32 - _COUNT_BITS)
    h = h.astype(np.intp)  # once, for the counts and the look-ups
    counts = np.bincount(h, minlength=1 << _COUNT_BITS)
    frequent = counts >= max(least, int(counts.max() * share))
    heavy = np.flatnonzero(frequent.take(h))
    slots = np.flatnonzero(frequent)
    slot = np.empty(1 << _COUNT_BITS, np.intp)
    slot[slots] = np.arange(len(slots))
    h = slot.take(h.take(heavy))
    pair = a.take(heavy).astype(np.uint64) << np.uint64(32) | b.take(heavy)
    stands = np.zeros(len(slots), np.uint64)
    stands[h] = pair
    same = np.flatnonzero(stands.take(h) == pair)
    heavy, h = heavy.take(same), h.take(same)
    own = np.bincount(h, minlength=len(slots))
    often = own >= max(least, int(own.max(initial=0) * share))
    keep = np.flatnonzero(often.take(h))
    number = np.cumsum(often) - 1
    return heavy.take(keep), number.take(h.take(keep)), stands[often]


def repair(ids: np.ndarray, min_pairs: int = MIN_PAIRS, rounds: int = ROUNDS,
           share: float = ROUND_SHARE) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, rules, first nonterminal): nonterminal first + i stands for the two symbols rules[i].

    A round counts all pairs and replaces, from left to right, every occurrence of
    those within ``share`` of the most frequent one; it ends when no pair has
    ``min_pairs`` occurrences or after ``rounds`` rounds.
    """
    seq = ids.astype(np.uint32)
    first = int(seq.max()) + 1 if len(seq) else 0
    rules: list[np.ndarray] = []
    made = 0
    for n in range(rounds):
        if len(seq) < 2:
            break
        at, no, pairs = _frequent_pairs(seq, min_pairs, share, n)
        if not len(at):
            break
        # neighbouring occurrences overlap: of a run every other one is replaced
        begins = np.concatenate([[True], np.diff(at) > 1])
        run_start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run_start) % 2 == 0
        at = at[take]
        seq[at] = (first + made + no[take]).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq.take(np.flatnonzero(keep))
        rules.append(np.column_stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype(np.uint32))
        made += len(pairs)
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), first


def expansions(rules: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, start, length) of every nonterminal's ids; rules refer only to earlier symbols."""
    n, of = len(rules), rules.astype(np.int64) - first
    of[of < 0] = n  # a terminal, of one id
    length = np.zeros(n + 1, np.int64)
    length[n] = 1
    levels, rest = [], np.arange(n)
    while len(rest):
        ready = (length[of[rest]] > 0).all(axis=1)
        if not ready.any():
            raise ValueError("rules refer to one another")
        levels.append(rest[ready])
        length[levels[-1]] = length[of[levels[-1]]].sum(axis=1)
        rest = rest[~ready]
    start = np.cumsum(length[:n]) - length[:n]
    flat = np.empty(int(length[:n].sum()), np.uint32)
    for level in levels:
        at = start[level]
        for side in 0, 1:
            part = of[level, side]
            end = part == n
            flat[at[end]] = rules[level[end], side]
            part, to = part[~end], at[~end]
            flat[ranges(to, length[part])] = flat[ranges(start[part], length[part])]
            at = at + length[of[level, side]]
    return flat, start, length[:n]


def pack_shard(ids: np.ndarray) -> bytes:
    """A shard: header, rules, their expansion lengths, the ids before every ``STRIDE``-th symbol, the symbols.

    Symbols take two bytes if there are at most 65,536 of them, else four.
    """
    seq, rules, first = repair(ids)
    _, _, length = expansions(rules, first)
    sizes = np.ones(len(seq), np.int64)
    nonterminal = seq >= first
    sizes[nonterminal] = length[seq[nonterminal] - first]
    before = (np.cumsum(sizes) - sizes)[::STRIDE]
    wide = 2 if first + len(rules) <= 1 << 16 else 4
    head = _MAGIC + struct.pack(_HEAD, len(ids), first, len(rules), len(seq), wide)
    return b"".join([head, rules.astype("<u4").tobytes(), length.astype("<u4").tobytes(), before.astype("<u8").tobytes(),
                     seq.astype(f"<u{wide}").tobytes()])


def _raw(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string or large_binary array without nulls; the offsets begin at 0."""
    offsets = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, 8 * a.offset) if len(a) else np.zeros(1, np.int64)
    n = int(offsets[-1] - offsets[0])
    return np.frombuffer(a.buffers()[2], np.uint8, n, int(offsets[0])) if n else np.zeros(0, np.uint8), offsets - offsets[0]


def _table(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ids that follow one another, as the bytes of little-endian 32-bit integers."""
    cuts = 4 * np.concatenate([[0], np.cumsum(lengths)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(cuts),
                                                                             pa.py_buffer(ids.astype("<u4", copy=False))])


def _gather(table: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the runs of numbers ``at``; Arrow copies each run as a whole."""
    return _raw(table.take(pa.array(at)))


class Shard:
    """A packed shard, opened; ``ids(start, n)`` decodes a range of ids from the nearest stored place before it."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token shard")
        self.n_ids, self.first, n_rules, n_seq, wide = struct.unpack_from(_HEAD, data, 4)
        at = 4 + struct.calcsize(_HEAD)
        rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(n_rules, 2)
        at += 8 * n_rules
        length = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.before = np.frombuffer(data, "<u8", -(-n_seq // STRIDE), at).astype(np.int64)
        at += 8 * len(self.before)
        self.seq = np.frombuffer(data, f"<u{wide}", n_seq, at)
        flat, start, found = expansions(rules, self.first)
        if len(data) != at + wide * n_seq or not np.array_equal(found, length):
            raise ValueError("damaged token shard")
        # one table of ids: the terminals as themselves, then the expansions
        self.table = _table(np.concatenate([np.arange(self.first, dtype="<u4"), flat]),
                            np.concatenate([np.ones(self.first, np.int64), length]))

    def ids(self, start: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.zeros(0, np.uint32)
        low = int(np.searchsorted(self.before, start, side="right")) - 1
        high = int(np.searchsorted(self.before, start + n, side="left"))
        out = _gather(self.table, self.seq[low * STRIDE:high * STRIDE])[0].view("<u4")
        skip = start - int(self.before[low])
        return out[skip:skip + n]


# --- encoding ------------------------------------------------------------------------------
# the byte-level pre-tokens, as ``_pretokens`` cuts them
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# line ends and the visible characters of Latin scripts: these split alike in every Unicode version
_PLAIN = "^[\n -~\u00a1-\u00ac\u00ae-\u024f]*$"

# what a character is to the byte-level pattern
_WHITE, _LETTER, _NUMBER, _MARK = range(4)


def _key(text: str) -> str:
    """What a string's ids are kept under: what follows its blank, or the string behind a further blank.

    A key without a blank before it is what stands between blanks of a text; ``_texts_of`` is the way back.
    """
    rest = text[1:]
    return rest if text[:1] == " " and rest and rest[0] != " " and not rest[-1].isspace() else " " + text


def _behind_blank(a: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar("", a.type), a, pa.scalar(" ", a.type))


def _texts_of(keys: pa.Array) -> pa.Array:
    """The strings of keys."""
    return pc.if_else(pc.starts_with(keys, " "), pc.utf8_slice_codeunits(keys, 1),
                      _behind_blank(keys))


def _word_keys(words: pa.Array) -> pa.Array:
    """``_key`` of pre-tokens, whose only blanks are one in front of visible characters or white space alone."""
    return pc.if_else(pc.match_substring_regex(words, "^ [^ \n]"), pc.utf8_slice_codeunits(words, 1),
                      _behind_blank(words))


def _strings(a: pa.Array) -> list[str]:
    """``to_pylist`` of strings without nulls, without a scalar for each."""
    return a.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes with a byte-level BPE of the tokenizers library, the distinct pieces of many texts at a time.

    A text is cut before the blanks that follow visible text: no pre-token crosses
    them, so the pieces' ids joined are the text's ids.  Pieces recur: every key has
    a code, and the ids of code c are ``pool[start[c]:start[c] + length[c]]``.  Code 0,
    without ids, is that of pieces that end in white space, which may go with a blank behind it.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        shown = [chr(b if b in visible else next(hidden)) for b in range(256)]
        self.splits = self._byte_level(shown)
        self.table = "".join(shown)
        self.blank = shown[32]
        self.model = self.tokenizer.model
        self.words = Tokenizer(self.model)
        # UTF-8 has no byte 255: it stands behind every word of a call, and no merge has it
        self.last = self.tokenizer.token_to_id(shown[255])
        if public_tokenizers.PATTERN != _PATTERN:
            raise ValueError("pre-tokens are cut by another pattern")
        signs = "".join(map(chr, range(0x250)))
        self.kinds = np.full(0x250, _MARK, np.uint8)
        for kind, form in (_WHITE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"):
            self.kinds[[m.start() for m in regex.finditer(form, signs)]] = kind
        self.cut = re.compile(r"(?<=\S) ")
        #: The keys with codes, of which the first one's is 1.
        self.known = pa.array([], pa.large_string())
        self.pool, self.start, self.length = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.met = np.zeros(1, np.int64)

    def _byte_level(self, shown: list[str]) -> bool:
        """Whether the tokenizer only splits by the byte-level pattern (else whole texts are encoded)."""
        import json

        spec = json.loads(self.tokenizer.to_str())
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                and pre.get("use_regex", True) and model.get("type") == "BPE" and not model.get("ignore_merges")
                and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                and all(x in model["vocab"] for x in shown) and sum(shown[255] in x for x in model["vocab"]) == 1)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    @property
    def codes(self) -> dict[str, int]:
        """The code of every key."""
        return dict(zip(self.known.to_pylist(), range(1, len(self.length)), strict=True))

    def _put(self, keys: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Give codes to new keys, whose ids follow one another."""
        n = len(self.length)
        self.known = pa.concat_arrays([self.known, keys])
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.pool = np.concatenate([self.pool, ids])
        self.met = np.concatenate([self.met, np.zeros(len(keys), np.int64)])
        return np.arange(n, n + len(keys))

    def _put_words(self, words: pa.Array) -> np.ndarray:
        """Encode pre-tokens, many in one call of the library."""
        raw, ends = _raw(pc.binary_join_element_wise(words.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()),
                                                     pa.scalar(b"\xff", pa.large_binary())))
        shown, ends = codecs.charmap_decode(raw, "strict", self.table)[0], ends.tolist()
        if len(words) <= FEW_WORDS:
            found = [t.id for begin, end in pairwise(ends) for x in (shown[begin:end - 1], shown[end - 1:end])
                     for t in self.model.tokenize(x)]
            ids = np.array(found, np.uint32)
        else:
            lots = []
            for i in range(0, len(words), CALL_WORDS):
                cuts = [*ends[i:min(i + CALL_WORDS, len(words)):LOT_WORDS], ends[min(i + CALL_WORDS, len(words))]]
                call = self.words.encode_batch_fast([shown[a:b] for a, b in pairwise(cuts)], add_special_tokens=False)
                lots += [np.array(x.ids, np.uint32) for x in call]
            ids = np.concatenate(lots)
        last = np.flatnonzero(ids == self.last)
        if len(last) != len(words):
            raise ValueError("the ids of some words cannot be told apart")
        return self._put(_word_keys(words), ids[ids != self.last], np.diff(last, prepend=-1) - 1)

    def _pretokens(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(pre-tokens, how many of each text): texts of plain characters cut by the byte-level pattern."""
        raw, offsets = _raw(texts)
        n = len(raw)
        kind = self.kinds.take(raw)
        wide = np.flatnonzero(raw >= 0xC2)  # the first of a character's two bytes
        if len(wide):
            kind[wide] = kind[wide + 1] = self.kinds.take(
                (raw[wide].astype(np.intp) & 0x1F) << 6 | raw[wide + 1].astype(np.intp) & 0x3F)
        head = np.zeros(n + 1, bool)  # where a text begins, or the last one ends
        head[offsets] = True
        begin = head.copy()
        begin[1:n] |= kind[1:] != kind[:-1]
        white = kind == _WHITE
        # the last white space before a visible character stands alone, or with this if it is a blank
        before = np.flatnonzero(white[:-1] & ~white[1:] & ~head[1:n])
        begin[before] = True
        begin[before + 1] = raw[before] != 32
        # 's, 't, 'm, 'd, 're, 've, 'll
        at = np.flatnonzero(raw == 39)
        at = at[begin[at] & ~head[at + 1]]
        if len(at):
            one, two = raw[at + 1], np.append(raw, 0)[at + 2]
            short = np.isin(one, list(b"stmd"))
            long = ((np.isin(one, list(b"rv")) & (two == 101)) | ((one == 108) & (two == 108))) & ~head[at + 2 - short]
            size = 1 + short + 2 * long
            begin[at[size > 1] + 1] = False
            begin[(at + size)[size > 1]] = True
        starts = np.flatnonzero(begin[:n])
        upto = np.concatenate([[0], np.cumsum(begin[:n])])
        cuts = np.append(starts, n).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(raw))
        return words, np.diff(upto[offsets])

    def _find(self, keys: pa.Array) -> np.ndarray:
        """The codes of distinct keys, -1 for new ones."""
        codes = np.asarray(pc.fill_null(pc.index_in(keys, self.known), -2)).astype(np.int64) + 1
        self.met[codes[codes > 0]] += 1
        return codes

    def _learn(self, keys: pa.Array) -> np.ndarray:
        """Codes of distinct new keys."""
        codes = np.zeros(len(keys), np.int64)
        plain = np.asarray(pc.match_substring_regex(keys, _PLAIN))
        behind = ~np.asarray(pc.starts_with(keys, " "))
        foreign = [(i, x) for i, x in zip(np.flatnonzero(~plain).tolist(), _strings(keys.filter(pa.array(~plain))), strict=True)
                   if not (behind[i] and x[-1].isspace())]
        if foreign:
            at = np.array([i for i, _ in foreign])
            ids = [self._whole(" " + x if behind[i] else x[1:]) for i, x in foreign]
            codes[at] = self._put(keys.take(pa.array(at)), np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
        at = np.flatnonzero(plain & ~(behind & np.asarray(pc.match_substring_regex(keys, "^$|[ \n]$"))))
        if not len(at):
            return codes
        keys = keys.take(pa.array(at))
        words, counts = self._pretokens(_texts_of(keys))
        words = words.dictionary_encode()
        forms, parts = words.dictionary, np.asarray(words.indices)
        found = self._find(_word_keys(forms))
        new = found < 0
        if new.any():
            found[new] = self._put_words(forms.filter(pa.array(new)))
        parts = found.take(parts)
        ends = np.cumsum(counts)
        one = counts == 1
        codes[at[one]] = parts[ends[one] - 1]
        if not one.all():
            lengths = np.diff(np.concatenate([[0], np.cumsum(self.length[parts])])[ends], prepend=0)
            codes[at[~one]] = self._put(keys.filter(pa.array(~one)), self._ids(parts[np.repeat(~one, counts)]), lengths[~one])
        return codes

    def _codes(self, keys: pa.Array) -> np.ndarray:
        """The codes of distinct keys."""
        codes = self._find(keys)
        new = codes < 0
        if new.any():
            codes[new] = self._learn(keys.filter(pa.array(new)))
        return codes

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        return self.pool.take(ranges(self.start.take(codes), self.length.take(codes)))

    def _forget(self) -> None:
        """Keep the ids of what was met in several slices only, and half as many as there may be at most."""
        least = 2
        while np.count_nonzero(self.met >= least) > CACHE_PIECES // 2:
            least *= 2
        kept = self.met >= least
        kept[0] = True
        self.known = self.known.filter(pa.array(kept[1:]))
        self.pool, self.length = self._ids(np.flatnonzero(kept)), self.length[kept]
        self.start = np.cumsum(self.length) - self.length
        self.met = np.zeros(len(self.length), np.int64)

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text (large_string, no nulls) as little-endian 32-bit integers."""
        if not self.splits:
            yield from (self._whole(x).astype("<u4").tobytes() for x in texts.to_pylist())
            return
        if not len(texts):
            return
        if len(self.known) >= CACHE_PIECES:
            self._forget()
        lists = pc.split_pattern(texts, " ")
        offsets = np.asarray(lists.offsets, np.int64)
        counts = np.diff(offsets)
        first, last = offsets[:-1] - offsets[0], offsets[1:] - offsets[0] - 1
        pieces = lists.flatten().dictionary_encode()
        forms, at = pieces.dictionary, np.array(pieces.indices, np.int64)
        heads = forms.take(pa.array(at[first])).dictionary_encode()
        # the forms that follow a blank, then the texts' first pieces, which follow none
        asked = np.bincount(at, minlength=len(forms)) > np.bincount(at[first], minlength=len(forms))
        asked = np.append(asked, np.ones(len(heads.dictionary), bool))
        codes = np.zeros(len(asked), np.int64)
        codes[asked] = self._codes(pa.concat_arrays([forms, _behind_blank(heads.dictionary)]).filter(pa.array(asked)))
        odd = codes == 0
        odd[len(forms):] = [x[-1:].isspace() for x in _strings(heads.dictionary)]
        at[first] = len(forms) + np.asarray(heads.indices)
        # a piece that ends in white space: nothing follows a last one; with others behind it, its text is cut anew
        odd = odd.take(at)
        odd[first[counts == 1]] = False
        odd_end = odd[last] & (counts > 1)
        odd[last] = False
        anew = np.logical_or.reduceat(odd, first)
        special = np.asarray(pc.match_substring(texts, "<|"))  # a special token's string may hold a blank
        some, whole = np.flatnonzero((anew | odd_end) & ~special), np.flatnonzero(special)
        keys, upto = [], [0]
        for i in some.tolist():
            text = texts[i].as_py()
            if anew[i]:
                head, *others = self.cut.split(text)
                keys += [" " + head, *(_key(" " + x) for x in others)]
            else:
                keys.append(_key(text[text.rindex(" "):]))
            upto.append(len(keys))
        keys = pa.array(keys, pa.large_string()).dictionary_encode()
        more = self._codes(keys.dictionary).take(np.asarray(keys.indices)) if len(keys) else np.zeros(0, np.int64)
        wholes = [self._whole(texts[i].as_py()) for i in whole.tolist()]
        # one table of ids for the slice: forms, first pieces, nothing, texts cut anew or their ends, whole texts
        sizes = np.concatenate([self.length[codes], [0], np.diff(np.concatenate([[0], np.cumsum(self.length[more])])[upto]),
                                np.fromiter(map(len, wholes), np.int64, len(wholes))])
        table = _table(np.concatenate([self._ids(codes), self._ids(more), *wholes]), sizes)
        none = np.flatnonzero(anew | special)
        at[ranges(first[none], counts[none])] = len(codes)
        at[np.where(anew, first, last)[some]] = len(codes) + 1 + np.arange(len(some))
        at[first[whole]] = len(codes) + 1 + len(some) + np.arange(len(whole))
        raw, ends = _gather(table, at)
        begin = 0
        for end in ends[last + 1].tolist():
            yield raw[begin:end].tobytes()
            begin = end

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        return next(self.encode_all(pa.array([text], pa.large_string())))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker and tokenizer file; a task has one core, so the library starts no threads."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


# --- the files -----------------------------------------------------------------------------
def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all texts' ids in shards; returns the written table (part, shard, doc_ids, sizes, data, n_ids).

    Rows are ranged by (doc_id, hash of the text), null ids first; a range is a part,
    whose shards follow one another.  A document is in one shard unless it is longer
    than ``shard_ids`` ids, when it is a shard of its own.  Null texts are empty and
    have the end id only.  ``tokenizer`` is a path on every executor.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # further keys, so that rows of one repeated id can lie in several ranges
    keys = ["doc_id", "text_hash", "row"]
    own = own.withColumn("text_hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        tail = np.array([end_id], "<u4").tobytes()
        shard, ids, sizes, data, size = 0, [], [], [], 0

        def closed():
            nonlocal shard, ids, sizes, data, size
            flat = np.frombuffer(b"".join(data), "<u4")
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([pack_shard(flat)], pa.binary()),
                 pa.array([size], pa.int64())], names=["part", "shard", "doc_ids", "sizes", "data", "n_ids"])
            shard, ids, sizes, data, size = shard + 1, [], [], [], 0
            return row

        for rows, texts in text_slices(batches, limit=ENCODE_BYTES):
            for doc_id, encoded in zip(rows.column(0).to_pylist(), coder.encode_all(texts), strict=True):
                encoded += tail
                n = len(encoded) // 4
                if ids and size + n > shard_ids:
                    yield closed()
                ids.append(doc_id)
                sizes.append(n)
                data.append(encoded)
                size += n
        if ids:
            yield closed()

    ranged = own.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return written(ranged.mapInArrow(
        run, "part int, shard int, doc_ids array<long>, sizes array<long>, data binary, n_ids long"), "token-shards")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards' decoded ids."""
    # shards in order: first the parts' totals, one row a part, then the shards of a part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("at"))
               .join(parts, "part").select("part", "shard", (F.col("base") + F.col("at")).alias("first_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.column(0)[i].as_py())
                sizes = np.asarray(b.column(2)[i].values, np.int64)
                starts = np.cumsum(sizes) - sizes
                raw = memoryview(shard.ids(0, shard.n_ids).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * s:4 * (s + n)]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1)[i].values, pa.array(starts + b.column(3)[i].as_py()), pa.array(sizes),
                     pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (shards.join(offsets, ["part", "shard"]).select("data", "doc_ids", "sizes", "first_id")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))
