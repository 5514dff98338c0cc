"""Filter audit, hard negatives and the token store against brute force, with the cases their docstrings define."""

import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tessera.llm import filter_audit, hard_negatives, packing, token_store
from tessera.llm.shared import scratch_path

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, part string, digest string, mask int, "
        "shard int, `hash` long")


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, "en", s, 1, "p", "d", 3, 9, 8) for i, t, s in rows], DOCS)


# Filter audit

def brute_audit(rows, labels):
    def fails(i, text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        return {f for f, bad in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
            ("E", i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows))) if bad}

    said = {}
    for i, q, t in labels:
        if i is not None:
            a = said.setdefault(i, [False, False])
            a[0] |= q == 1
            a[1] |= t == 1
    parts = {}
    for i, t, s in rows:
        parts.setdefault(s or "", []).append((fails(i, t or ""), *said.get(i, (False, False))))
    out = []
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        own = []
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                own.append((part, "".join(order), step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                            sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in own]
    return sorted(out)


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(2)
    words = ["w%d" % i for i in range(300)]
    texts = [None, "", " ", "A B", "é" * 30, "x # y", "a " * 60, " ".join(words[:60]), " ".join(words[:60]) + " $",
             " ".join(words[:60]).upper(), " ".join(rng.choices(words[:45], k=90)), " ".join(rng.choices(words, k=40000))]
    rows = [(i, rng.choice(texts[:-1]), rng.choice(["a", "b", "", None])) for i in range(90)]
    rows += [(5, texts[7], "a"), (5, texts[7], "a"), (None, texts[7], "b"), (None, None, None), (200, texts[-1], "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)]
    return rows, labels + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]


def test_filter_audit_against_brute_force(spark, audited):
    rows, labels = audited
    found = filter_audit.audit(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, labels)


def test_filter_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs_of(spark, []), none).count() == 0
    found = filter_audit.audit(docs_of(spark, [(1, "a", None)]), none).collect()
    assert len(found) == 600 and {r["part"] for r in found} == {""}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 10**15), min_size=32, max_size=32))
def test_shapley_is_the_mean_over_all_orders(by_mask):
    out = filter_audit.removals(by_mask)
    sums = [0] * 5
    for order in permutations(range(5)):
        held = 0
        for f in order:
            sums[f] += out[held | 1 << f] - out[held]
            held |= 1 << f
    assert filter_audit.shapley(out) == [Fraction(x, 120) for x in sums]


# Hard negatives

VECTORS = "vec_id long, label int, embedding array<float>, block int, score int, vector string, `rank` int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, lab, v, 1, 2, "c", 3) for i, lab, v in rows], VECTORS)


def brute_mining(rows, every):
    held = {}
    for i, lab, v in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
        if i not in held or (lab, list(map(np.float32, v))) < held[i][2]:
            held[i] = (lab, q, (lab, list(map(np.float32, v))))
    out = []
    for a, (lab, q, _) in held.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, p)), i, other) for i, (other, p, _) in held.items() if i != a]
        scores.sort()
        for s, name, _ in [x for x in scores if x[2] == lab][:5]:
            near = [x for x in scores if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(a, name, k, i, -s, -t) for k, (t, i, _) in enumerate(near[:5], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    centres = rng.normal(size=(6, 16)) / 2
    for i in range(-40, 660):
        c = int(rng.integers(6))
        v = (centres[c] + rng.normal(size=16) * rng.choice([0.05, 0.4])).astype(np.float32)
        label = None if i % 83 == 5 else int(c if rng.random() < 0.7 else rng.integers(6))
        rows.append((i, label, v.tolist()))
    rows += [(1000 + i, i % 2, [1.0, 0.5]) for i in range(30)]          # ties, other lengths
    rows += [(2000, 1, None), (2001, 1, [float("nan")] * 16), (2002, 1, [float("inf")] + [0.0] * 15),
             (2003, 1, [None] + [0.0] * 15), (2005, 1, []), (None, 1, [1.0] * 16)]
    rows += [rows[3], rows[3], (10, 5, [2.0] * 16), (10, 2, [1.0] * 16), (10, 2, [0.5] * 16)]
    return rows


@pytest.mark.parametrize("span_rows, group_anchors", [(8192, 2048), (100, 17)])
def test_hard_negatives_against_brute_force(spark, vectors, span_rows, group_anchors):
    found = hard_negatives.mined(vectors_of(spark, vectors), F.col("vec_id") % 10 == 0, span_rows=span_rows,
                                 group_anchors=group_anchors)
    want = brute_mining(vectors, 10)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 300


def test_hard_negatives_of_nothing(spark):
    some = [(1, 1, [1.0]), (2, 1, [1.0])]
    for rows in ([], some, [(100, 1, [1.0]), (200, None, [1.0])]):
        assert hard_negatives.mined(vectors_of(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_of_large_components(spark):
    rows = [(0, 1, [2.0**22, 1.0]), (1, 1, [2.0**21, 0.0]), (2, 2, [2.0**21, -1.0]), (3, 2, [2.0**21 - 1, 5.0])]
    found = hard_negatives.mined(vectors_of(spark, rows), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute_mining(rows, 100) != []


def test_few_rows_are_scored_again():
    """Anchors and rows in tight clusters: bounds along the tree spare most scores."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 32)) * 200
    def block(n):
        labels = rng.integers(12, size=n)
        order = np.argsort(labels, kind="stable")
        return hard_negatives.Block(np.arange(n), labels[order], np.floor(centres[labels[order]] + rng.normal(size=(n, 32))))
    rows, anchors = block(3000), block(200)
    order, parents, edges = hard_negatives.spanning_tree(anchors.vectors)
    place = np.argsort(order)
    held = hard_negatives.Block(anchors.ids[order], anchors.labels[order], anchors.vectors[order])
    walk = hard_negatives.Walk(rows, held, np.where(parents < 0, -1, place[parents]), edges)
    assert len(list(hard_negatives._same_label(walk, 5))) == 200
    assert walk.scored < 0.2 * 3000 * 200 and not walk.open


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(size=(40, 3)) * 50)
    points[7] = points[3]
    order, parents, edges = hard_negatives.spanning_tree(points)
    away = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    group, total = list(range(40)), 0.0
    for d, a, b in sorted((away[a, b], a, b) for a in range(40) for b in range(a)):
        if group[a] != group[b]:
            total += d
            group = [group[a] if g == group[b] else g for g in group]
    assert sorted(order) == list(range(40)) and parents[0] == -1
    assert np.isclose(edges.sum(), total) and all(p in order[:i] for i, p in enumerate(parents) if i)


# Token store

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**63 - 1), st.just(0)), max_size=700), st.booleans())
def test_elias_fano(values, wide):
    values = sorted(values if wide else [v % 1000 for v in values])
    if wide and values and len(values) < 3:
        values[-1] += 2**63
    seq = token_store.EliasFano.encode(np.array(values, np.uint64))
    again, end = token_store.EliasFano.read(memoryview(b"ab" + seq.tobytes()), 2, len(values))
    assert end == 2 + len(seq.tobytes())
    assert again.values().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values
    for x in (values[:3] + [0, 7, 2**62]):
        assert again.find(x) == sum(v < x for v in values)


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 20000))
    assert 8 * len(token_store.EliasFano.encode(ends).tobytes()) < 20000 * (2.5 + np.log2(ends[-1] / 20000))
    with pytest.raises(ValueError, match="fall"):
        token_store.EliasFano.encode(np.array([2, 1]))


def test_segment():
    documents = [(-5, np.array([1, 2], "<u2")), (3, np.array([7], "<u2")), (3, np.array([2], "<u2")),
                 (2**62, np.array([9, 9, 2], "<u2")), (None, np.array([2], "<u2"))]
    data = token_store.Segment.of(4, 2, documents).tobytes()
    (one, two) = token_store.segments(data + b"\n" + data + b"\n")
    assert two.doc_ids() == [d for d, _ in documents] and (one.shard, one.number, len(one)) == (4, 2, 5)
    assert [one.document(i).tolist() for i in range(5)] == [x.tolist() for _, x in documents]
    assert [one.find(x) for x in (3, -5, 2**62, 4, -9)] == [[1, 2], [0], [3], [], []]
    damaged = bytearray(data)
    damaged[80] ^= 1
    for bad in (bytes(damaged), data[:-3], b"x" + data):
        with pytest.raises(ValueError):
            list(token_store.segments(bad))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    rows = [(rng.randrange(-2000, 2000), " ".join(rng.choices(["the", "a", "été", "日本", "x1"], k=rng.randrange(40))), "s")
            for _ in range(300)]
    rows += [(77, f"hot {i}", "s") for i in range(200)] + [(77, "same", "s")] * 3     # an id that fills shards
    return rows + [(None, None, "s"), (None, "no id", "s"), (5, "", "s"), (9, "word " * 60000, "s"),
                   (11, "a" + " " * 1_200_000 + "b", "s"), (12, "<|endoftext|>", "s")]


@pytest.mark.parametrize("shard_bytes, segment_ids", [(32 << 20, 1 << 22), (900, 64)])
def test_token_store_round_trip(spark, texts, shard_bytes, segment_ids):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    ids = {t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for _, t, _ in texts}
    path = scratch_path(spark, "tokens")
    docs = docs_of(spark, texts).repartition(5)
    token_store.write_tokens(docs, path, packing.default_tokenizer(), shard_bytes=shard_bytes, segment_ids=segment_ids)
    got = sorted(token_store.read_tokens(spark, path, keep_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _, _ in texts if d is not None)) + [None, None]
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    assert (sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got)
            == sorted((str(d), ids[t].tobytes()) for d, t, _ in texts))
    shards = token_store.read_segments(spark, path).select("shard", "doc_id").distinct().collect()
    if shard_bytes == 900:  # the hot id is spread
        assert len({r["shard"] for r in shards}) > 20 and len({r["shard"] for r in shards if r["doc_id"] == 77}) > 1


def test_token_store_of_nothing(spark):
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(docs_of(spark, []), path, packing.default_tokenizer())
    assert token_store.read_tokens(spark, path).count() == 0


def test_token_store_refuses_other_files(spark):
    path = scratch_path(spark, "tokens")
    spark.createDataFrame([("not a segment, but long enough for the header of one" * 3,)], "value string").write.text(path)
    with pytest.raises(PythonException, match="not a segment"):
        token_store.read_tokens(spark, path).count()


def test_packing_of_long_blanks(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    encode = packing.encoder(packing.default_tokenizer())
    for text in (" " * 1_000_000, "a" * 1_000_000, "x" + "\n" * 1_200_000 + " y", "# " * 500_000):
        assert encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids
    rows = [(1, " " * 1_200_000, "s"), (2, "b", "s")]
    found = packing.pack(docs_of(spark, rows), packing.default_tokenizer()).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    assert all(r["n"] == r["d"] for r in found) and len(found) == 2
