"""Parts that need no session: words, plans, the label model, allocation, records."""

import gzip
import random
import re
import tracemalloc
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import line_dedup, mixing, packing, quality, tokensets, warc, words

TEXT = st.text(st.sampled_from("aAbé \n\t\x0b.,#|ñ漢"), max_size=60)


def found_words(texts, size):
    out = []
    for s in words.slices(pa.array(texts, pa.string()), size):
        for i in range(len(s)):
            a, b = s.word_from[i], s.word_from[i + 1]
            out.append([bytes(s.raw[x:y]).decode() for x, y in zip(s.starts[a:b], s.ends[a:b])])
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.sampled_from([1, 16, 1 << 20]))
def test_words_of_whole_texts(texts, size):
    assert found_words(texts, size) == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def brute_shingles(text):
    w = [x.lower() for x in (text or "").encode().split()]
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_shingle_sets_agree_with_brute_force():
    rng = random.Random(3)
    texts = [None, "", "one", "One", "a b c d", "a b c d e"] + [
        " ".join(rng.choices(["a", "B", "c", "d"], k=rng.randint(1, 40))) for _ in range(80)]
    sets = [s[i] for part in words.slices(pa.array(texts, pa.string()), 64)
            for s in [tokensets.text_sets(part)] for i in range(len(s))]
    for t, s in zip(texts, sets):
        assert len(s) == len(brute_shingles(t))
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert words.overlap(sets[i], sets[j]) == len(brute_shingles(texts[i]) & brute_shingles(texts[j]))


def test_work_on_a_batch_holds_little_memory():
    text = " ".join(f"w{i}" for i in range(500))
    batch = pa.array([text] * 1600, pa.string())
    assert batch.nbytes > 3 << 20
    for work in (quality.features, line_dedup._line_sets):
        tracemalloc.start()
        for s in words.slices(batch):
            work(s)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 24 << 20, work


def test_short_lines_are_hashed_together(monkeypatch):
    mixings, plain = [], words.mixed
    monkeypatch.setattr(words, "mixed", lambda x: mixings.append(len(x)) or plain(x))
    n = np.arange(3000) % 8
    bounds = np.concatenate([[0], np.cumsum(n)])
    hashes = np.tile(np.arange(1, 9, dtype=np.uint64), 3000)[: bounds[-1]]
    out, ends = words.shingle_runs(bounds, hashes)
    assert len(mixings) < 20
    assert np.diff(ends).tolist() == [max(0, k - 4) if k >= 5 else min(k, 1) for k in n]
    for i in (1, 2, 3, 4, 5, 6, 7, 11, 2998):  # a group alone has the same shingles
        own, _ = words.shingle_runs(np.array([0, n[i]]), hashes[bounds[i]: bounds[i + 1]])
        assert own.tolist() == out[ends[i]: ends[i + 1]].tolist()


def test_lines_of_texts():
    texts = ["a b\n\n c\n", None, "x", "\n \ny z", ""]
    got = []
    for s in words.slices(pa.array(texts, pa.string()), 4):
        text, line, bounds = tokensets.line_bounds(s)
        got += [(s.first + t, n, z - a) for t, n, a, z in zip(text, line, bounds[:-1], bounds[1:])]
    assert got == [(0, 0, 2), (0, 2, 1), (2, 0, 1), (3, 2, 2)]
    assert line_dedup.without_lines("a\nb\n\nc", {1}) == "a\n\nc"


def brute_features(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=6), st.sampled_from([8, 1 << 20]))
def test_features_agree_with_brute_force(texts, size):
    got = []
    for s in words.slices(pa.array(texts, pa.string()), size):
        f = quality.features(s)
        got += list(zip(*(f[c].tolist() for c in quality.FEATURES[:5])))
    assert got == [brute_features(t) for t in texts]


def test_label_model_finds_rules_that_err():
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.85
    right = np.array([[.99, .97, .95, .9], [.8, .6, .7, .5]])
    votes = np.where(rng.random((20000, 4)) < right[(~good).astype(int)], np.where(good, 1, -1)[:, None],
                     np.where(good, -1, 1)[:, None])
    votes[rng.random((20000, 4)) < 0.1] = 0
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, found, posterior = quality.fit(patterns, counts)
    assert abs(share - 0.85) < 0.08
    assert found[0, 0] > found[0, 3] and found[1, 0] > found[1, 3]  # the better rule is seen to be better
    every = (votes >= 0).all(1)                                     # against all-must-pass on the same votes
    said = posterior[place.ravel()] >= 0.5
    assert (said == good).mean() > 0.93 > (every == good).mean()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 5000) | st.integers(1, 60) | st.sampled_from([512, 1024, 2048]), max_size=60))
def test_packing_plan_places_every_id_once(lengths):
    windows, kinds = packing.plan(lengths)
    seen = {d: [] for d in range(len(lengths))}
    for window, kind in zip(windows, kinds):
        assert sum(n for _, _, n in window) == kind and kind & (kind - 1) == 0 and kind <= 1024
        for d, start, n in window:
            seen[d].append((start, n))
    for d, pieces in seen.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at and n > 0
            at += n
        assert at == lengths[d]


def test_step_groups_balance():
    sizes = [1024] * 300 + [512] * 40 + [1, 2, 4]
    groups = packing.step_groups(sizes, 16 * 1024)
    loads = np.bincount(groups, sizes)
    assert loads.max() - loads.min() <= 1024


def test_ids_are_those_of_tokenizers():
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    encode, rng = packing.encoder(path), random.Random(2)
    alphabet = [chr(c) for c in range(32, 300)] + list("\n\t  漢😀́٣") + ["'s", "  ", "<|endoftext|>"] * 9
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        assert encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_are_the_repeated_resharing(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total = Fraction(3, 2) * sum(sizes)
    want, open_, left = [Fraction(0)] * len(sizes), set(range(len(sizes))), total
    while open_:  # as stated: cap those above, share the rest by weight again
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > 2 * sizes[i]}
        for i in over or open_:
            want[i] = Fraction(2 * sizes[i]) if over else unit * weights[i]
        if not over:
            break
        left -= sum(want[i] for i in over)
        open_ -= over
    got = mixing.targets(sizes, weights, float(total))
    assert got == pytest.approx([float(x) for x in want], abs=1e-6)


def test_archive_records_parse():
    block = b"H\r\n\r\n\r\n\r\nx"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\n" + block + b"\r\n\r\n"
    rows = list(warc.parse(gzip.compress(record) + gzip.compress(record)))
    assert [b for _, b in rows] == [block, block] and rows[0][0]["warc-type"] == "response"
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")))
    assert list(warc.parse(gzip.compress(b""))) == []


def test_random_strings_score_above_identifiers():
    from tessera.llm import secrets
    import base64
    import hashlib

    def pairs(values):
        out = {}
        for v in values:
            for a, b in zip(v, v[1:]):
                out[a, b] = out.get((a, b), 0) + 1
        return out

    rng = random.Random(4)
    parts = ["the", "ing", "re", "con", "tion", "_", "get", "value", "er", "an", "or", "count", "list"]
    ident = ["".join(rng.choices(parts, k=7)) for _ in range(4000)]
    noise = [base64.b64encode(hashlib.sha512(str(i).encode()).digest()).decode()[:rng.randint(24, 60)] for i in range(4000)]
    model = secrets.ratios(pairs(noise[:3000]), pairs(ident[:3000]))
    index = {c: i for i, c in enumerate(secrets.ALPHABET)}

    def score(v):
        return sum(model[index[a] * len(secrets.ALPHABET) + index[b]] for a, b in zip(v, v[1:]))

    said = [score(v) >= secrets.LEAST_TOTAL and score(v) >= secrets.LEAST_MEAN * (len(v) - 1) for v in
            noise[3000:] + ident[3000:]]
    assert sum(said[:1000]) >= 990 and sum(said[1000:]) <= 5


def test_sets_are_sorted_exactly():
    """Hashes that agree in their leading bits, in either branch of the sort."""
    base = np.uint64(0x1234567800000000)
    close = base + np.array([5, 3, 5, 1, 3, 5], np.uint64)
    for copies in (1, 400):
        hashes = np.concatenate([close] * copies)
        bounds = np.array([0, len(hashes)])
        sets = tokensets.Sets(hashes, bounds)
        assert sets.tokens.tolist() == [int(base) + x for x in (1, 3, 5)]
    two = tokensets.Sets(np.concatenate([close, close[:2]]), np.array([0, 6, 6, 8]))
    assert two.sizes.tolist() == [3, 0, 2] and two[2].tolist() == [int(base) + 3, int(base) + 5]


def test_lines_of_a_rare_shingle_are_compared_pair_by_pair():
    token, size = np.array([1, 1, 2, 2, 3, 3, 4], np.uint64), np.array([10, 8, 10, 8, 10, 7, 9], np.uint32)
    place = np.array([2, 1, 0, 0, 0, 0, 0], np.uint32)
    # 1: too few shingles stand behind; 3: sizes too far apart; 4: alone
    assert line_dedup.has_partner(token, size, place).tolist() == [False, False, True, True, False, False, False]
    many = line_dedup.SMALL_GROUP + 1  # sizes only
    got = line_dedup.has_partner(np.ones(many, np.uint64), np.full(many, 10, np.uint32), np.full(many, 2, np.uint32))
    assert got.all()
    rng = np.random.default_rng(3)
    token, size = rng.integers(0, 60, 300).astype(np.uint64), rng.integers(1, 30, 300).astype(np.uint32)
    place = (rng.random(300) * (size // 5 + 1)).astype(np.uint32)
    got, n, p = line_dedup.has_partner(token, size, place), size.astype(int), place.astype(int)
    for i in range(300):
        others = [j for j in np.flatnonzero(token == token[i]) if j != i]
        able = [j for j in others if 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j])
                and 9 * min(n[i] - p[i], n[j] - p[j]) >= 4 * (n[i] + n[j])]
        assert got[i] or not able  # none is lost
        assert got[i] == bool(able) or len(others) >= line_dedup.SMALL_GROUP


def test_postings_of_a_bucket_are_ordered():
    rng = np.random.default_rng(4)
    for tokens in (rng.integers(0, 50, 500), rng.integers(0, 1 << 62, 500), np.zeros(0, np.int64)):
        tokens = tokens.astype(np.uint64)
        owners, extra = (rng.integers(0, k, len(tokens)).astype(np.uint64) for k in (9, 5))
        group = tokensets.posting_batch([(0, tokens.tobytes(), owners.tobytes(), extra.astype("<u2").tobytes())])
        got = tokensets.gathered(pa.Table.from_batches([group]))
        assert list(zip(*(x.tolist() for x in got))) == sorted(zip(tokens.tolist(), owners.tolist(), extra.tolist()))
