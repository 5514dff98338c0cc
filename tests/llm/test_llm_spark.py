"""The operators on small tables: brute force, oracles, and the cases their docstrings define."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import (fingerprint, jaccard_join, line_dedup, mixing, packing, quality, secrets, shared, sharding, tokensets,
                         url_filter, warc, words)
from tessera.llm.queries import ORACLE, QUERIES
from tessera.llm.shared import components, scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, n long, id int, `kept` int"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None, "h", 1, 2, 3) for i, t, s in rows],
                                 DOCS)


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empties, repeats, copies, near copies, a long text, ties."""
    rng = random.Random(11)
    word = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    base = [" ".join(rng.choices(word, k=rng.randint(60, 140))) for _ in range(12)]
    rows = [(1, None, "a"), (2, "", None), (3, "   \n\t", "b"), (4, "Two words", "a"), (5, "two  WORDS", None),
            (6, "x", "a"), (7, " ".join(rng.choices(word, k=30000)), "b"), (8, base[0], "c"), (8, base[0], "c"),
            (None, base[1], "a"), (None, None, None)]
    n = 10
    for b in base:
        for _ in range(4):
            w = b.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(word)
            lines = " ".join(w[:30]) + "\n" + " ".join(w[30:])
            rows.append((n, rng.choice([lines, lines.upper(), b + "\n" + base[0]]), rng.choice("abc")))
            n += 1
    return rows


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, oracle, name):
    got = QUERIES[name](spark, SF)
    rel = oracle.sql(ORACLE[name])
    cols = sorted(rel.columns)
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == want


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert quality.keep_good(none).count() == 0
    assert line_dedup.drop_repeated_lines(none).count() == 0
    assert jaccard_join.linked(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert packing.pack(none, packing.default_tokenizer()).count() == 0
    assert sharding.shard(none, ["lang", "n_chars"]).count() == 0
    assert secrets.scan(none).count() == 0
    assert fingerprint.neighbours(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.apply_rules(pages, url_filter.RULES).count() == 0
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    warc.write_responses(pages, a)
    warc.deduplicate(spark, a, b)
    assert warc.read_headers(spark, b).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(1, 60)} == {1}


def test_warc_revisits(spark):
    big = "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX-Page-ID: 9", big), (2, None, big), (2, "u", big), (3, "u", "x" * 999), (4, "u", "x" * 999),
         (5, "u", None), (None, "u", big)], "page_id long, url string, html string")
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    warc.write_responses(pages, a)
    warc.deduplicate(spark, a, b)
    rows = warc.resolved(warc.read_headers(spark, b)).collect()
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in rows)
    assert kinds == Counter([(1, "revisit", 2), (2, "revisit", 2), (2, "response", None), (3, "response", None),
                             (4, "response", None), (5, "response", None), (None, "revisit", 2)])
    assert {r["digest"] for r in rows if r["page_id"] == 2} == {hashlib.sha1(big.encode()).hexdigest()}
    whole = {r["page_id"]: r["payload"] for r in warc.read_records(spark, b).where("record_type = 'response'").collect()}
    assert whole == {2: big, 3: "x" * 999, 4: "x" * 999, 5: ""}


def brute_sets(rows):
    out = []
    for _, t, _ in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def similar(a, b):
    return a and b and 100 * len(a & b) >= 80 * len(a | b)


def test_jaccard_join_against_brute_force(spark, odd_rows):
    sets = brute_sets(odd_rows)
    name = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                name = [name[j] if x == name[i] else x for x in name]
    low = defaultdict(list)
    for k, (i, _, _) in zip(name, odd_rows):
        low[k].append(i)
    want = Counter((i, len(s), min((x for x in low[k] if x is not None), default=None))
                   for (i, _, _), s, k in zip(odd_rows, sets, name))
    docs = docs_of(spark, odd_rows)
    got = Counter(map(tuple, jaccard_join.linked(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == want
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {k for k, s in zip(name, sets) if s}
    empty = [i for (i, _, _), s in zip(odd_rows, sets) if not s]
    assert kept.count() == len(groups) + len(empty)


def test_jaccard_join_within_families(spark):
    """Copies of one original, most below 0.8 of it: cut short, with edits that several share, longer than it."""
    rng = random.Random(5)
    word = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(3000)]
    rows, n = [], 0
    for size, with_original in ((60, True), (90, False), (150, True)):
        base = rng.choices(word, k=size)
        edits = [(rng.randrange(size), rng.choice(word)) for _ in range(6)]
        texts = [base] if with_original else []
        for _ in range(45):
            w = list(base)
            for at, x in rng.sample(edits, rng.randint(0, 4)) + [(rng.randrange(size), rng.choice(word))] * rng.randint(0, 2):
                w[at] = x
            cut = rng.randint(0, size // 5)
            texts.append(rng.choice([w, w[cut:], w[:size - cut], w + rng.choices(word, k=cut), w[cut // 2:size - cut // 2]]))
        for w in texts:
            rows.append((n, " ".join(w), "a"))
            n += 1
    sets = brute_sets(rows)
    name = list(range(n))
    for i in range(n):
        for j in range(i):
            if similar(sets[i], sets[j]):
                name = [name[j] if x == name[i] else x for x in name]
    first = {}
    for i, k in enumerate(name):
        first.setdefault(k, i)
    assert len(first) > 12
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked(docs_of(spark, rows)).collect()}
    assert got == {i: first[k] for i, k in enumerate(name)}


def test_jaccard_join_moves_only_texts_that_may_have_a_link(spark, monkeypatch):
    rng = random.Random(5)
    text = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(400)]
    rows = [(i, t, "a") for i, t in enumerate(text)] + [(400 + i, text[i] + " more", "a") for i in range(5)] + [
        (400, text[0] + " more", "a")]
    packed, moved, pack = [], [], jaccard_join.packed_texts

    def spy(docs, name):
        packed.append(docs.count())
        return pack(docs, name)

    monkeypatch.setattr(jaccard_join, "packed_texts", spy)
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, sets: moved.append(sets.count()) or tokensets.verified(
        pairs, sets))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked(docs_of(spark, rows)).collect()}
    assert got == {i: i if i < 400 else i - 400 for i in range(405)}
    assert len(packed) == 1 and 11 <= packed[0] < 60  # of 406
    # The row that repeats is fetched once; the second verification reads only the sets that its pairs name.
    assert moved[0] == 10 and moved[1] < 10


def test_likely_in_keeps_every_wanted_row(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("word"))
    for sizes in (0, 1, 300, 3000):
        wanted = shared.stored(rows.where(F.col("id") < sizes).select("word"), "wanted")
        got = shared.likely_in(rows, "word", wanted)
        assert got.columns == rows.columns
        ids = [r["id"] for r in got.collect()]
        assert len(ids) == len(set(ids)) and {i for i in range(sizes) if i % 7} <= set(ids)
        assert len([i for i in ids if i % 7]) < sizes + 0.2 * (4000 - sizes)


def test_short_postings_never_count_less(spark):
    # Tokens of one set whose halves are alike, and a token that only looks like another set's.
    low, far = 12345, np.uint64(1) << np.uint64(40)
    own = np.sort(np.array([low, low + far, low + 2 * far, 99, 100], np.uint64))
    assert tokensets.alike(own, np.zeros(5, np.uint64)).tolist() == [False, False, False, True, True]
    assert not tokensets.alike(own, np.arange(5, dtype=np.uint64)).any()
    sets = spark.createDataFrame([(i, 5, bytearray(own.tobytes())) for i in (1, -2)] + [
        (3, 2, bytearray(np.array([7, 8], np.uint64).tobytes()))], "id long, n long, tokens binary")
    got = tokensets.with_common(shared.stored(sets, "sets"), np.zeros(0, np.uint64), "common").collect()
    assert {r["id"]: r["common"] for r in got} == {1: 5, -2: 5}


def test_jaccard_join_of_a_small_region(spark):
    """A set with too few shingles in its region for a bound, similar to one with enough."""
    rng = random.Random(3)

    def hashed(texts):
        return tokensets.text_sets(next(iter(words.slices(pa.array(texts)))))

    def grown(text, low):
        """``text`` with a word more; the new shingle's hash lies in the region or far from it."""
        while True:
            word = "".join(rng.choices("abcdefgh", k=9))
            x = int(hashed([" ".join([*text[-4:], word])]).tokens[0]) / 2.0 ** 64
            if x < 0.4 if low else x > 0.6:
                return [*text, word]

    small = ["w1", "w2", "w3", "w4"]
    for k in range(70):
        small = grown(small, k < 10)
    large = small
    for _ in range(14):
        large = grown(large, True)
    rows = [(1, " ".join(small), "a"), (2, " ".join(large), "a"), (3, "some other text of seven words", "a")]
    regions = jaccard_join.Regions(hashed([t for _, t, _ in rows]))
    assert regions.odd.tolist() == [True, False, False]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked(docs_of(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_line_dedup_against_brute_force(spark, odd_rows):
    lines = sorted({(i is None, i, (t or ""), k, x) for i, t, _ in odd_rows for k, x in enumerate((t or "").split("\n"))},
                   key=lambda r: (r[0], r[1] or 0, r[3]))
    seen, gone = [], defaultdict(set)
    for _, i, t, k, x in lines:
        s = brute_sets([(0, x, 0)])[0]
        if s:
            if any(similar(s, e) for e in seen):
                gone[i, t].add(k)
            seen.append(s)
    found, n, lost = line_dedup.deduplicated(docs_of(spark, odd_rows))
    for r in found.collect():
        out = gone.get((r["doc_id"], r["text"] or ""), None)
        assert r[lost] <= r[n]
    got = Counter((r["doc_id"], r["text"]) for r in found.collect())
    want = Counter((i, line_dedup.without_lines(t, gone[i, t]) if t is not None and gone.get((i, t)) else t)
                   for i, t, _ in odd_rows)
    assert got == want


def test_line_dedup_of_edited_families(spark):
    """Lines edited in several words, the originals among the later ones: few are decided by a leader."""
    rng, rows = random.Random(5), []
    for size in (30, 46, 61):
        word = [f"v{rng.randrange(10**6)}" for _ in range(300)]
        base = rng.choices(word, k=size)
        shared = [(rng.randrange(size), rng.choice(word)) for _ in range(3)]
        for k in range(60):
            w = list(base)
            if k != 40:
                for at, x in rng.sample(shared, rng.randint(0, 2)) + [(rng.randrange(size), rng.choice(word))] * rng.randint(0, 1):
                    w[at] = x
                w[rng.randrange(size)] = rng.choice(word)
            rows.append((len(rows), " ".join(w), "a"))
    sets, want = brute_sets(rows), set()
    for i in range(len(rows)):
        if any(similar(sets[i], sets[j]) for j in range(i)):
            want.add(i)
    assert 10 < len(want) < len(rows) - 10
    assert {r["doc_id"] for r in line_dedup.removed_lines(docs_of(spark, rows)).collect()} == want


def test_line_dedup_looks_small_families_up_by_prefix(spark, monkeypatch):
    """A few near copies of a line make no family: its tables stay empty, the copies go all the same."""
    rng, rows, sizes = random.Random(6), [], {}
    for _ in range(30):
        words = [f"w{rng.randrange(10**7)}" for _ in range(40)]
        for k in range(6):
            rows.append((len(rows), " ".join(words[:38] + [f"x{rng.randrange(10**7)}", f"y{k}"]), "a"))

    def counted(df, name, batch_rows=None, store=line_dedup.stored):
        out = store(df, name, batch_rows)
        sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    gone = line_dedup.removed_lines(docs_of(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in gone) == [i for i in range(180) if i % 6]
    assert all(r["gone"] == [0] for r in gone)
    assert sizes["leaders"] == sizes["families"] == sizes["differing"] == 0


def test_frequent_shingles_of_a_batch_come_once(spark):
    every, later = "this line is held by every text of the batch", "this other line is held by half of them only"
    rows = [(i, "\n".join([later] * (i >= 100) + [every, " ".join(f"w{i}x{k}" for k in range(600))]), "x")
            for i in range(400)]
    hot = np.sort(np.concatenate([s.tokens for part in words.slices(pa.array([every, later]), 1)
                                  for s in [tokensets.text_sets(part)]]))
    found = line_dedup.shared_prefixes(docs_of(spark, rows).coalesce(1), hot, 1)
    with shared.arrow_rows(spark, 1000):
        got = [(r["token"], r["id"]) for r in found.collect()]
    assert len(got) == len(set(got)) >= 4


def test_line_dedup_fetches_wanted_lines_of_texts_that_are_not_sorted(spark):
    docs = line_dedup._keyed(docs_of(spark, [(1, "a b\n\nc d e", "x"), (1, "a b\n\nc d e", "x"), (2, "f", "x")]), "doc_id", "text")
    wanted = docs.where("doc_id = 1").distinct().selectExpr("doc_id", "hash", "2 as line")
    assert [r["n"] for r in line_dedup._fetched(docs, wanted).collect()] == [1, 1]
    out, _, _ = line_dedup.deduplicated(docs_of(spark, [(1, "a b c", "x"), (2, "A b c", "x"), (3, "d", "x")]))
    plan = out._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r["n_removed"] for r in out.collect()) == [0, 0, 1]

def test_fingerprints(spark, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 8] + [(8, "same text of a few words more", "a")]
    got = {r["doc_id"]: r for r in fingerprint.neighbours(docs_of(spark, rows)).collect()}
    texts = {i: t or "" for i, t, _ in rows}
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        after = ids[(k + 1) % len(ids)]
        edited = fingerprint.edited(texts[i], texts[after])
        assert got[i]["n_chars"] == len(texts[i])
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["near_next"] == 1.0) == (got[i]["fingerprint"] == got[after]["fingerprint"])
    assert got[1]["fingerprint"] == got[2]["fingerprint"]
    long, half = texts[7], " ".join(texts[7].split()[:15000])
    sketch = fingerprint.sketches(__import__("pyarrow").array([long, half]))
    assert fingerprint.containment(sketch[1], sketch[0]) > 0.99
    assert abs(fingerprint.containment(sketch[0], sketch[1]) - 0.5) < 0.05
    parts = spark.createDataFrame([("g", sketch[0][1]), ("g", sketch[1][1]), ("h", "=0")], "g string, fingerprint string")
    union = dict(fingerprint.merged(parts, "g").collect())
    assert union == {"g": sketch[0][1], "h": "="}


def test_packing_round_trip(spark, odd_rows):
    from tokenizers import Tokenizer
    import numpy as np
    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack(docs_of(spark, odd_rows), packing.default_tokenizer(), keep_ids=True, block_tokens=5000).collect()
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in odd_rows)
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["tier"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], "<u4")))
    for found in sequences.values():
        at = 0
        for offset, n, tier in sorted(found):
            assert offset == at
            at += n
        assert at == tier
    once = {k: n for k, n in want.items() if n == 1 and sum(x[0] == k[0] for x in want) == 1}
    for i, ids in once:
        if i is not None:
            assert tuple(np.concatenate([x for _, x in sorted(pieces[i, len(ids)], key=lambda p: p[0])])) == ids


def test_shards(spark, odd_rows):
    rows = odd_rows + [(1000 + k, "t" * (k % 37), f"s{k % 5}") for k in range(3000)]
    got = sharding.shard(docs_of(spark, rows), ["source", "lang", "n_chars", "doc_id"], shards=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(7))
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    even = [(k, "x" * 50, "s") for k in range(5000)]
    sizes = Counter(r["shard"] for r in sharding.shard(docs_of(spark, even), ["source", "doc_id"], shards=7).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 12


def test_quality_rules(spark, odd_rows):
    docs = docs_of(spark, odd_rows + [(500 + k, "Buy!! NOW!! " * 30, "a") for k in range(3)])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1, 2, 3, 4, 5, 6, 500, 501, 502} and 7 in ids


@pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not present")
def test_quality_on_labels(spark):
    path = "/root/testdata/sf0.01"
    got = QUERIES["op7_quality_rules"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    rows = got.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    rate = dict(map(tuple, rows))
    assert rate[1] >= 0.98 and rate[0] <= 0.05


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, None, 0), (2, "no scheme", 0), (3, "http://WWW.Example.com/en/x?q=/es/", 0),
                                   (4, "https://a.b.net/fr/#x", 0), (5, "x://notnet/fr/", 0), (6, "x://com", 0),
                                   (6, "x://com", 0), (7, "x://y.com/en", 0)], "page_id long, url string, verdict int")
    out = url_filter.apply_rules(pages, url_filter.RULES)
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["_verdict"]) for r in out.collect())
    assert got == Counter([(1, "", "", None, "allow"), (2, "", "", None, "allow"),
                           (3, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
                           (4, "a.b.net", "/fr/", "net/fr/", "block"), (5, "notnet", "/fr/", None, "allow"),
                           (6, "com", "", None, "allow"), (6, "com", "", None, "allow"),
                           (7, "y.com", "/en", "com/", "allow")])
    assert url_filter.apply_rules(pages, []).where("rule is not null").count() == 0


def brute_spans(text):
    out = []
    assign = re.compile(secrets.ASSIGN.replace("(?i)", ""), re.I | re.A)
    out += [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secret_spans(spark, odd_rows):
    rng = random.Random(5)
    key = "q7XzP0vLk9Tn3RwY5sHd8FbJ2mGc6UaE1oIx4ZtN"
    texts = ["é😀 token = '" + "ab12" * 4 + "' AKIA" + "Z9" * 8, "AKIASHORT secret:x secret: password=longenough1", "a" * 33,
             "key " + key + " end", "API-KEY=12345678 apikey:12345678", "f" * 31 + "g" + "0" * 32 + "AKIA" * 5]
    texts += ["".join(rng.choices(["token", "=", ":", " ", "AKIA", "ABCDEFGH", "0123456789abcdef", "é", "\n"], k=30))
              for _ in range(40)]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(r[0] and 7007, *r[1:]) for r in odd_rows if r[0] in (None, 7)]
    parts = ["the", "ing", "re", "con", "tion", "_", "get", "value", "er", "an", "or", "count", "list", "Map", "Set"]
    rows += [(3000 + k, " ".join("".join(rng.choices(parts, k=7)) for _ in range(20)), "a") for k in range(200)]
    got = secrets.scan(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    text_of = dict((i, t) for i, t, _ in rows if i is not None)
    for r in got:
        if r["doc_id"] is not None:
            want = brute_spans(text_of[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
            assert [x for x in r["spans"].split(",") if x and not x.startswith("markov")] == [x for x in want.split(",") if x]
    by = {r["doc_id"]: r for r in got}
    assert by[7007]["spans"] == "" and sum(r["n_markov"] for i, r in by.items() if (i or 0) >= 3000) == 0


def test_markov_span_among_identifiers(spark):
    rng = random.Random(6)
    key = "q7XzP0vLk9Tn3RwY5sHd8FbJ2mGc6UaE1oIx4ZtN"
    parts = ["the", "ing", "re", "con", "tion", "_", "get", "value", "er", "an", "or", "count", "list", "Map", "Set"]
    rows = [(k, " ".join("".join(rng.choices(parts, k=7)) for _ in range(20)), "a") for k in range(300)]
    rows.append((900, f"é key {key} end", "a"))
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs_of(spark, rows)).collect()}
    assert got.pop(900) == f"markov:6:{6 + len(key)}" and set(got.values()) == {""}


@pytest.mark.parametrize("n_ids, n_keys", [(1000, 500), (300, 900)])
def test_markov_spans_of_many_secrets(spark, n_ids, n_keys):
    """Unlabelled secrets, half as many as distinct identifiers or more, do not train the ordinary model."""
    rng = random.Random(8)
    parts = ["the", "ing", "re", "con", "tion", "_", "get", "value", "er", "an", "or", "count", "list", "Map", "Set"]
    ids = ["".join(rng.choices(parts, k=8)) for _ in range(n_ids)]
    keys = ["".join(rng.choices(secrets.ALPHABET[:62], k=40)) for _ in range(n_keys)]
    rows = [(k, x, "a") for k, x in enumerate(ids + keys)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs_of(spark, rows)).collect()}
    assert sum(got[k] == "" for k in range(n_ids)) >= 0.99 * n_ids
    assert sum(got[n_ids + k] == "markov:0:40" for k in range(n_keys)) >= 0.98 * n_keys


def test_markov_stretches(spark):
    """Keys inside long runs of ordinary characters, and joined to a match of a pattern."""
    rng = random.Random(9)
    parts = ["the", "ing", "re", "con", "tion", "_", "get", "value", "er", "an", "or", "count", "list", "Map", "Set", "/"]

    def path(n):
        return "".join(rng.choices(parts, k=n))[:n]

    rows = [(k, " ".join(path(40) for _ in range(20)), "a") for k in range(150)]
    want = {}
    for k in range(200, 240):
        x, y = ("".join(rng.choices(secrets.ALPHABET[:62], k=40)) for _ in range(2))
        hex_ = "".join(rng.choices("0123456789abcdef", k=32))
        a, b, c = path(150), path(150), path(90)
        text, places = [(f"{a}/{x}/{b}", [len(a) + 1]), (f"{a}/{x}/{b}/{y}/{c}", [len(a) + 1, len(a) + len(b) + 43]),
                        (f"é {x}/{hex_}-{y}", [2, 76]), (f"{x}/AKIA{'Z9' * 8}-{a}/{y}", [0, 63 + len(a)])][k % 4]
        rows.append((k, text, "a"))
        want[k] = places
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs_of(spark, rows)).collect()}
    assert sum(got[k] != "" for k in range(150)) == 0
    hits = 0
    for k, places in want.items():
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[k].split(",") if x.startswith("markov")]
        hits += sum(any(abs(p - a) <= 6 and abs(p + 40 - b) <= 6 for a, b in spans) for p in places)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_rows_of_the_driver_need_no_python_worker(spark):
    rows = [("a", 1.5, [(1, 2, 0.5), (3, 4, 1.0)], None), (None, None, [], 7)]
    schema = "s string, x double, parts array<struct<after: long, until: long, most: double>>, extra long"
    found = shared.driver_rows(spark, rows, schema)
    assert [tuple(map(str, r)) for r in found.collect()] == [
        tuple(map(str, r)) for r in spark.createDataFrame(rows, schema).collect()]
    assert found.dtypes == spark.createDataFrame(rows, schema).dtypes
    assert shared.driver_rows(spark, [], schema).count() == 0
    few = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), (None, 9, 3)], "source string, size long, draw long")
    plan = mixing.allocation(few)
    assert "RDD" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 2


def test_mixing(spark, odd_rows):
    rows = odd_rows + [(2000 + k, " ".join(["w"] * (1 + k % 90)), "big" if k % 3 else f"s{k % 7}") for k in range(1500)]
    docs = docs_of(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    again = Counter(r["doc_id"] for r in mixing.mix(docs.repartition(5)).collect())
    assert Counter(r["doc_id"] for r in out.collect()) == again
    size = Counter()
    for i, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    aims = dict(zip(order, mixing.targets([size[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))],
                                          1.5 * sum(size.values()))))
    taken = Counter()
    for r in out.collect():
        taken[r["source"]] += len((r["text"] or "").split())
    assert abs(taken["big"] - aims["big"]) < 90
    assert all(n <= 2 for k, n in again.items() if k not in (8, None))
    for s in order:
        assert taken[s] <= 2 * size[s]


@pytest.mark.parametrize("share", [0.5, 1.5])
def test_mixing_of_few_long_documents(spark, share):
    """No document that is left out would fit."""
    shape = {"a": [20000] * 3 + [150] * 200, "b": [9000] * 5 + [40] * 300, "c": [3000, 7, 7, 5, 1] * 20}
    rng = random.Random(4)
    rows = [(s, n, rng.randrange(-2 ** 63, 2 ** 63)) for s in shape for n in shape[s]]
    plan = mixing.allocation(spark.createDataFrame(rows, "source string, size long, draw long"), (1.0,), share)
    frame = spark.createDataFrame(rows, "s string, size long, draw long").join(plan, F.col("s") == F.col("source"))
    got = frame.select("source", "size", "target", "whole", mixing.copies(F.col("draw"), F.col("size")).alias("n")).collect()
    for s in shape:
        mine = [r for r in got if r["source"] == s]
        taken, target = sum(r["size"] * r["n"] for r in mine), mine[0]["target"]
        out = [r["size"] for r in mine if r["n"] == r["whole"]]
        assert abs(target - taken) <= min(out, default=0), s


def test_pipeline_stages(spark, odd_rows):
    docs = docs_of(spark, [(i, t, s) for i, t, s in odd_rows])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names, name
        assert out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_shards_of_odd_numbers_and_equal_rows(spark):
    odd = [float("nan"), float("inf"), -float("inf"), None, -5.0, 1e9, 0.0]
    rows = [(i, "x" * (i % 50), odd[i % 7] if i % 2 else float(i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x double")
    found = sharding.shard(docs, ["x"], shards=4).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r["b"] for r in found]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 4 + 66
    same = spark.createDataFrame([(1, "same text")] * 4000, "doc_id long, text string").repartition(3)
    counts = [r["count"] for r in sharding.shard(same, ["doc_id"], shards=4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 20
