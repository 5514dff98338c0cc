"""Line dedup as an exact set-similarity join.

A line is the set of its five-word shingles (a shorter one its whole sequence). A line goes if
an earlier line, in the order of document id and line number, has 0.8 of Jaccard similarity or
more with it; whether that earlier line itself stays does not matter, so the result does not
depend on the order of work. Lines without words stay.

The join is the prefix filter: a line's shingles are ordered by rarity (those that many lines
hold come last, by the bounded list of frequent shingles; the rest by hash) and only the first
floor(n / 5) + 1 of them are looked up: similar lines share one of those. Length and positional
filters drop candidates, the rest are verified on whole sets. The filters begin where a
shingle's lines meet: in the order of their sizes, a line without a near enough neighbour has no
partner there; the lines of a rare shingle are compared pair by pair.

Equal lines are one set from the start. Candidates come in two rounds: each line against the
earliest line that shares a rare shingle and against the line of that shingle that shares most of
its prefix with others (two pairs per line and shingle), then, only for lines that
this did not decide, against the other earlier ones. A family of near copies is thus decided by
pairs with its first member, not by all pairs. In the second round two lines of one family are
compared by what sets each apart from the shingles that most of the family hold
(``family_repeats``); only pairs of other lines are looked up by prefix. That is for families of
``FAMILY_LINES`` lines or more: a smaller one is looked up by prefix, so a line meets a bounded number
of its own family there.

Defined results: a null text stays null, a text without line breaks is one line. Rows of equal id
and text have the same lines kept. Null ids come last. In ``drop_repeated_lines`` a document all
of whose lines with words go is dropped itself; documents that had no words stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import drop_stored, small_batches, stored, table, unused
from tessera.llm.tokensets import (BLOB_ROWS, POSTINGS, TEXT_ROWS, Dealer, Frequency, Sets, buckets_for, can_overlap,
                                   compatible, frequent, gathered, is_in, line_bounds, missing, posting_batch,
                                   shared_by_sets, signed, text_sets, verified, with_common)
from tessera.llm.words import shingle_runs, slices

_U = np.uint64
_BLANKS = " \t\n\v\f\r"  # what no word holds
_LINES = "doc_id long, hash long, line int, id long, n int, tokens binary, counts binary"
#: Positions that a posting's two bytes can hold; a later one counts as this (the filter then says less).
_LAST_POSITION = 65535
#: A posting's position stands above its line's size, which counts as this at most: larger ones are all alike.
_LAST_SIZE = 65535
#: Families of fewer lines are looked up by prefix, like lines of no family.
FAMILY_LINES = 64
#: Where a shingle's lines are compared pair by pair for whether they can be similar.
SMALL_GROUP = 16


def _line_sets(s) -> tuple[np.ndarray, np.ndarray, Sets]:
    """Text, line number and set of each line that holds a word."""
    text, line, bounds = line_bounds(s)
    return text, line, Sets(*shingle_runs(bounds, s.word_hashes()))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in _LINES.split(", ")]
    for batch in batches:
        often, rows = Frequency(), []
        for s in slices(batch.column(2)):
            text, line, sets = _line_sets(s)
            often.add(sets.tokens[sets.rank() <= missing(sets.sizes)[sets.owner]], len(sets))
            at = pa.array(text + s.first)
            rows.append([batch.column(0).take(at), batch.column(1).take(at), pa.array(line.astype(np.int32)),
                         signed(sets.ids()), pa.array(sets.sizes.astype(np.int32))])
        tokens, counts = often.found()
        told = False
        for columns in rows:
            blobs = [[None] * len(columns[0]) for _ in range(2)]
            if not told and len(columns[0]):
                blobs[0][0], blobs[1][0], told = tokens.tobytes(), counts.astype("<i8").tobytes(), True
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(b, pa.binary()) for b in blobs)], names=names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for t, n in zip(b.column(0), b.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t.as_py(), "<i8")),
                                              pa.array(np.frombuffer(n.as_py(), "<i8"))], names=["token", "n"])


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("hash"),
                       docs[text].alias("text"))


def prefixes(sets: Sets, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The prefix of each set by rarity: (shingle, set number, position, shingle is frequent)."""
    often = is_in(sets.tokens, hot)
    tokens, owner = sets.tokens, sets.owner
    if often.any():  # frequent ones behind the others, both by hash
        order = np.lexsort((tokens, often, owner))
        tokens, often = tokens[order], often[order]
    place = sets.rank()
    use = place <= missing(sets.sizes)[owner]
    return tokens[use], owner[use], place[use], often[use]


def has_partner(tokens: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which postings, of different lines, have one of the same token whose line can be similar.

    By the sizes of the lines; where at most ``SMALL_GROUP`` lines hold a token, also by the shingles behind it
    in both, pair by pair.
    """
    order = np.lexsort((sizes, tokens))
    t, n, place = tokens[order], sizes[order].astype(np.int64), places[order].astype(np.int64)
    new = np.ones(len(t), bool)
    new[1:] = t[1:] != t[:-1]
    run = np.cumsum(new) - 1
    lines = np.bincount(run)[run] if len(t) else run
    found = np.zeros(len(t), bool)
    near = np.flatnonzero(~new[1:] & (5 * n[:-1] >= 4 * n[1:]) & (lines[1:] > SMALL_GROUP))
    found[near] = found[near + 1] = True
    left = np.flatnonzero(lines <= SMALL_GROUP)
    behind = np.where((n >= _LAST_SIZE) | (place >= _LAST_POSITION), 1 << 40, n - place)  # not known: enough
    for apart in range(1, SMALL_GROUP):
        left = left[left + apart < len(t)]
        left = left[run[left + apart] == run[left]]
        a, b = left, left + apart
        able = (5 * n[a] >= 4 * n[b]) & (9 * np.minimum(behind[a], behind[b]) >= 4 * (n[a] + n[b]))
        found[a[able]] = found[b[able]] = True
    out = np.zeros(len(t), bool)
    out[order] = found
    return out


def shared_prefixes(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """token, id, place, many: prefix postings of shingles that prefixes of two or more lines of near sizes hold.

    ``many``: of a shingle that ``FAMILY_LINES`` of those lines hold, or that is frequent. Postings of frequent
    shingles come as they are, once per batch that holds them.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(buckets)
        for batch in batches:
            known = []
            for s in slices(batch.column(0)):
                sets = _line_sets(s)[2]
                ids = sets.ids()
                tokens, owner, place, often = prefixes(sets, hot)
                extra = (np.minimum(place, _LAST_POSITION) << 16) | np.minimum(sets.sizes, _LAST_SIZE)[owner]
                extra = extra.astype("<u4")
                yield from dealer.add(tokens[~often], ids[owner[~often]], extra[~often])
                if often.any():
                    known.append((tokens[often], ids[owner[often]], extra[often]))
            if known:  # held by many lines for certain: each batch a bucket of its own
                tokens, own, extra = map(np.concatenate, zip(*known))
                yield posting_batch([(-1 - int(own[0] % _U(1 << 30)), tokens.tobytes(), own.tobytes(), extra.tobytes())])
        yield from dealer.rest()

    def meet(group: pa.Table) -> pa.Table:
        tokens, owners, extra = gathered(group, "<u4")
        fresh, shared = shared_by_sets(tokens, owners)
        met = group.column("bucket")[0].as_py() >= 0  # all postings of these tokens are here
        use = fresh & shared if met else fresh
        tokens, owners, extra = tokens[use], owners[use], extra[use]
        if met:
            use = has_partner(tokens, extra & 0xFFFF, extra >> 16)
            tokens, owners, extra = tokens[use], owners[use], extra[use]
        _, run, lines = np.unique(tokens, return_inverse=True, return_counts=True)
        many = (lines >= FAMILY_LINES)[run] if met else np.ones(len(tokens), bool)
        return pa.table({"token": signed(tokens), "id": signed(owners), "place": pa.array((extra >> 16).astype(np.int32)),
                         "many": pa.array(many)})

    return (docs.select("text").mapInArrow(emit, POSTINGS).groupBy("bucket")
            .applyInArrow(meet, "token long, id long, place int, many boolean"))


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, n, tokens of the wanted lines, from the texts that hold them first; stored.

    ``wanted``: doc_id, hash, line. Texts that occur twice under one id give their lines twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = []  # only the wanted lines of a text are taken apart
            for text, lines in zip(batch.column(0), batch.column(1)):
                parts = text.as_py().split("\n")
                asked += [parts[i] for i in lines.as_py()]
            for s in slices(pa.array(asked, pa.large_string())):
                sets = text_sets(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.ids().view(np.int64)), pa.array(sets.sizes),
                     pa.array([sets[i].tobytes() for i in range(len(sets))], pa.binary())], names=["id", "n", "tokens"])

    by_text = wanted.groupBy("doc_id", "hash").agg(F.collect_list("line").alias("lines"))
    # The texts pass by a hash table of the wanted lines: they are not sorted.
    texts = docs.alias("t").join(
        by_text.hint("shuffle_hash").alias("w"),
        F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.hash") == F.col("w.hash")))
    found = texts.select("t.text", "w.lines").mapInArrow(run, "id long, n long, tokens binary")
    return stored(found, "line-sets", TEXT_ROWS)


def _order(prefix: str = "") -> Column:
    """Place of a line in the corpus; null ids last."""
    return F.struct(F.col(f"{prefix}doc_id").isNull().alias("last"), F.col(f"{prefix}doc_id").alias("doc_id"),
                    F.col(f"{prefix}hash").alias("hash"), F.col(f"{prefix}line").alias("line"))


#: SQL: the overlap that similar sets need is still possible when a shared shingle stands here in both.
_POSITION = "9 * (1 + least(n - place, m - at) - 1) >= 4 * (n + m)"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (leader, tokens): leader, token and how many rows of the batch hold it."""
    for batch in batches:
        sets = [np.frombuffer(x.as_py(), "<i8") for x in batch.column(1)]
        leader = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in sets])
        tokens = np.concatenate([np.zeros(0, np.int64), *sets])
        order = np.lexsort((tokens, leader))
        leader, tokens = leader[order], tokens[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (leader[1:] != leader[:-1]) | (tokens[1:] != tokens[:-1])
        at = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays([pa.array(leader[at]), pa.array(tokens[at]),
                                          pa.array(np.diff(np.append(at, len(tokens))))], names=["leader", "token", "c"])


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (id, leader, tokens, core, n, at): the core's size l, k in common, and the shingles that only one of them holds."""
    for batch in batches:
        size, common, differ = [], [], []
        for x, y in zip(batch.column(2), batch.column(3)):
            u, v = np.frombuffer(x.as_py(), "<u8"), np.sort(np.asarray(y.as_py(), np.int64).view(_U))
            both = is_in(u, v)
            size.append(len(v))
            common.append(int(both.sum()))
            near = len(u) + len(v) - 2 * common[-1] <= len(u) // 2
            differ.append(np.concatenate([u[~both], v[~is_in(v, u)]]).tobytes() if near else None)
        use = pa.array([x is not None for x in differ], pa.bool_())
        columns = [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(common, pa.int64()),
                   pa.array(differ, pa.binary()), batch.column(4), batch.column(5)]
        yield pa.RecordBatch.from_arrays([c.filter(use) for c in columns],
                                         names=["id", "leader", "l", "k", "differ", "n", "at"])


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of (id, differ)."""
    for batch in batches:
        arrays = [np.frombuffer(x.as_py(), "<i8") for x in batch.column(1)]
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in arrays])
        tokens = np.concatenate([np.zeros(0, np.int64), *arrays])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(tokens)], names=["id", "token"])


def near_families(found: DataFrame, open_: DataFrame, sets: DataFrame) -> DataFrame:
    """id, leader, l, k, differ, n, at of the lines of families in which an open line has an earlier one; stored.

    A line's leader, which names its family, is the line of a shared prefix shingle that has the largest part in
    common with others, followed to its own leaders. The family's core are the l shingles that more than half of its
    lines hold; a line holds k of them and differs from the core in the shingles ``differ``. Only lines that differ
    in half as many shingles as they have, or fewer; only families of ``FAMILY_LINES`` lines or more.
    """
    found = found.where("many")
    rank = F.struct((F.col("common") / F.col("n")).alias("part"), "id")
    best = found.groupBy("token").agg(F.max(rank).alias("best"))
    lead = found.select("token", "id", "at").join(best, "token").groupBy("id").agg(
        F.max("best")["id"].alias("leader"), F.first("at").alias("at"))
    lead = nearest = stored(lead, "leaders")
    up = lead.select(F.col("id").alias("leader"), F.col("leader").alias("up"))
    for _ in range(2):
        lead = lead.join(up, "leader").select("id", "at", F.col("up").alias("leader"))
    lead = stored(lead, "leaders")
    drop_stored(nearest)
    known = lead.groupBy("leader").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("lines"))
    live = (lead.join(open_, "id").join(known, "leader")
            .where((F.col("at") > F.col("from")) & (F.col("lines") >= FAMILY_LINES))
            .select("leader", "lines").distinct())
    members = stored(sets.select("id", "n", "tokens").join(lead.select("id", "leader", "at"), "id").join(live, "leader"),
                     "members", BLOB_ROWS)
    held = members.select("leader", "tokens").mapInArrow(_held, "leader long, token long, c long")
    core = (held.groupBy("leader", "token").agg(F.sum("c").alias("c")).join(live, "leader").where("2 * c > lines")
            .groupBy("leader").agg(F.collect_list("token").alias("core")))
    rows = members.join(core, "leader").select("id", "leader", "tokens", "core", "n", "at")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = stored(rows.mapInArrow(_apart, "id long, leader long, l long, k long, differ binary, "
                                         f"n {kinds['n']}, at {kinds['at']}"), "families", BLOB_ROWS)
    drop_stored(lead, members)
    return out


def family_repeats(open_: DataFrame, family: DataFrame, sets: DataFrame) -> DataFrame:
    """id: the open lines that are similar to an earlier line of their family.

    ``family``: as of ``near_families``. Lines Q and S that hold k and j shingles of a core of l have
    k + j - l shingles in common and besides one for each shingle in which both differ from the core. Where
    k + j - l suffice, the earliest line of each closeness to the core decides. Otherwise so many differing shingles
    are shared that, in the order of their rarity, the first shared one has enough behind it in both lines.
    """
    # 9 * (k + j - l + shared) >= 4 * (n + m) with the parts of each line gathered: short + b_short - l <= 9 * shared.
    family = family.withColumn("short", F.expr("5 * l - 9 * k + 4 * n"))
    mine = family.join(open_, "id", "left_semi")
    steps = (family.where("short <= l").groupBy("leader", F.col("short").alias("b_short"))
             .agg(F.min("at").alias("b_at")))
    plain = stored(mine.where("short <= l").join(steps, "leader")
                   .where((F.col("b_at") < F.col("at")) & F.expr("short + b_short <= l")).select("id").distinct(), "plain")
    differing = stored(family.select("id", "differ").mapInArrow(_differing, "id long, token long")
                       .join(family.drop("differ"), "id"), "differing")
    rarity = differing.groupBy("leader", "token").agg(F.count(F.lit(1)).alias("c"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("c", "token"))
    tokens = differing.join(rarity, ["leader", "token"]).where("c > 1").withColumn(
        "left", F.count(F.lit(1)).over(Window.partitionBy("id")) + 1 - place)
    tokens = stored(tokens, "ordered")
    drop_stored(differing)
    mine = mine.join(plain, "id", "left_anti").select("id")
    left = tokens.join(mine, "id", "left_semi").select("leader", "token", "id", "l", "n", "at", "short", "left")
    right = tokens.select("leader", "token", F.col("id").alias("b"), F.col("n").alias("m"), F.col("at").alias("b_at"),
                          F.col("short").alias("b_short"), F.col("left").alias("b_left"))
    pairs = (left.join(right, ["leader", "token"])
             .where((F.col("b_at") < F.col("at")) & F.expr(compatible("n", "m"))
                    & F.expr("short + b_short - l <= 9 * least(`left`, b_left)"))
             .select(F.col("id").alias("a"), "b"))
    links = verified(pairs, sets)
    out = stored(plain.union(links.select("a")).distinct(), "repeats")
    drop_stored(plain, tokens, links)
    return out


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, hash (of the text), gone: the numbers of the lines that go, a row per text that loses any; stored."""
    texts = _keyed(docs, doc_id, text)
    rows = stored(texts.mapInArrow(_lines, _LINES), "lines", TEXT_ROWS)
    first = stored(rows.groupBy("id").agg(F.min(_order()).alias("at"), F.first("n").alias("n"),
                                          F.count(F.lit(1)).alias("c")), "first")
    size = first.agg(F.sum(F.floor(F.col("n") / 5) + 1).alias("postings"), F.count(F.lit(1)).alias("sets")).first()
    blobs = rows.where("tokens is not null").select("tokens", "counts")
    hot = frequent(blobs.mapInArrow(_counted, "token long, n long"), size["sets"])
    found = shared_prefixes(texts, hot, buckets_for(size["postings"] or 0))
    # One shuffle by line: its postings once, its size and place, and the part of its prefix that others hold.
    found = found.repartition("id").distinct().join(first.select("id", "n", "at"), "id")
    line = Window.partitionBy("id")
    part = F.count(F.lit(1)).over(line) / (F.floor(F.col("n") / 5) + 1)
    found = found.withColumn("part", part).withColumn("one", F.col("token") == F.min("token").over(line))
    found = shared = stored(found, "shared", TEXT_ROWS)
    # Two lines of a shingle stand for its others: the earliest one and the one that shares most of its prefix.
    line = F.struct("at", "id", "n", "place")
    leaders = (found.groupBy("token").agg(F.min(line).alias("x"), F.max_by(line, F.struct("part", "id")).alias("y"),
                                          F.count(F.lit(1)).alias("c")).where("c > 1")
               .select("token", F.explode(F.array("x", "y")).alias("l"))
               .select("token", F.col("l.id").alias("b"), F.col("l.at").alias("b_at"), F.col("l.n").alias("m"),
                       F.col("l.place").alias("b_place")))
    possible = (F.col("b_at") < F.col("at")) & F.expr(compatible("n", "m")) & F.expr(
        _POSITION.replace("at)", "b_place)"))
    pairs = found.join(leaders, "token").where(possible).select(F.col("id").alias("a"), "b").distinct()
    pairs = stored(pairs, "pairs")
    # Lines that take part in any later look-up: with a length-compatible partner in a shared shingle.
    wanted = found.where("one").select("at.doc_id", "at.hash", "at.line")
    sets = with_common(_fetched(texts, wanted), hot, "common")
    # What other lines hold of two lines bounds what they have in common.
    counts = sets.select("id", "n", "common")
    of_b = counts.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("common").alias("d"))
    able = F.expr(can_overlap("common", "n", "d", "m"))
    likely = pairs.join(counts.withColumnRenamed("id", "a"), "a").join(of_b, "b").where(able).select("a", "b")
    links = verified(likely, sets)
    decided = links.select("a").distinct()
    found = able_lines = stored(found.join(counts.select("id", "common"), "id"), "able")
    drop_stored(shared)
    open_ = undecided = stored(counts.select("id").join(decided.withColumnRenamed("a", "id"), "id", "left_anti"), "open")
    family = near_families(found, open_, sets)
    repeats = family_repeats(open_, family, sets)
    # Pairs that no family holds.
    found = found.join(family.select("id", "leader"), "id", "left")
    open_ = found.join(open_.join(repeats, "id", "left_anti"), "id", "left_semi")
    earlier = found.select("token", F.col("id").alias("b"), F.col("n").alias("m"), F.col("at").alias("b_at"),
                           F.col("place").alias("b_place"), F.col("common").alias("d"), F.col("leader").alias("of"))
    rest = (open_.join(earlier, "token")
            .where(possible & able & F.expr("leader is null or of is null or leader <> of"))
            .select(F.col("id").alias("a"), "b").distinct().join(pairs, ["a", "b"], "left_anti"))
    last = verified(rest, sets)
    drop_stored(able_lines, pairs, sets, family, undecided)
    near = decided.withColumnRenamed("a", "id").union(repeats).union(last.select(F.col("a").alias("id"))).distinct()
    marks = first.join(near.withColumn("near", F.lit(True)), "id", "left").where("c > 1 or near")
    gone = rows.select("doc_id", "hash", "line", "id").join(
        marks.select("id", "at", "near").hint("shuffle_hash"), "id")
    gone = gone.where(F.coalesce("near", F.lit(False)) | (_order() != F.col("at")))
    gone = stored(gone.groupBy("doc_id", "hash").agg(F.collect_set("line").alias("gone")), "gone")
    drop_stored(rows, first, links, repeats, last)
    return gone


def without_lines(text: str, lines: set[int]) -> str:
    """``text`` without the lines of these numbers."""
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with the text less its removed lines, and the names of two new columns.

    These are the number of lines with words and how many of them went.
    """
    small_batches(docs.sparkSession)
    gone = removed_lines(docs, doc_id, text)
    i, h, g, n_lines, n_removed = unused(docs, "gone_id", "gone_hash", "gone", "n_lines", "n_removed")
    gone = gone.select(F.col("doc_id").alias(i), F.col("hash").alias(h), F.col("gone").alias(g))
    key, here = unused(docs.withColumn(i, F.lit(0)).withColumn(h, F.lit(0)).withColumn(g, F.lit(0)), "key", "here")
    held = docs.withColumn(key, docs[doc_id].cast("long")).withColumn(here, F.xxhash64(docs[text]))
    joined = held.join(gone.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col(i)) & (F.col(here) == F.col(h)), "left").drop(i, h, key, here)
    place, lines = joined.columns.index(text), joined.columns.index(g)
    schema = T.StructType([f for f in docs.schema.fields]
                          + [T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts, counts, lost, new = part.column(place).to_pylist(), [], [], []
                for body, out in zip(texts, part.column(lines)):
                    out = set(out.as_py() or ())
                    counts.append(sum(bool(x.strip(_BLANKS)) for x in (body or "").split("\n")))
                    lost.append(len(out))
                    new.append(without_lines(body, out) if out else body)
                columns = [pa.array(new, pa.string()) if j == place else part.column(j)
                           for j in range(part.num_columns) if j != lines]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(lost, pa.int64())],
                                                 names=[f.name for f in schema.fields])

    return joined.mapInArrow(run, schema), n_lines, n_removed


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars"
                        ) -> DataFrame:
    """The documents with their remaining lines; those that lost every line with words go."""
    found, lines, lost = deduplicated(docs, doc_id, text)
    kept = found.where((F.col(lost) == 0) | (F.col(lost) < F.col(lines)))
    if n_chars in docs.columns:
        kept = kept.withColumn(n_chars, F.when(F.col(lost) == 0, F.col(n_chars)).otherwise(
            F.length(text)).cast(docs.schema[n_chars].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    found, lines, lost = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col(lines).alias("n_lines"), F.col(lost).alias("n_removed"), "text")


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS body,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line
  FROM documents),
words AS (
  SELECT doc_id, line,
         [x FOR x IN string_split_regex(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM lines),
sets AS (
  SELECT row_number() OVER (ORDER BY doc_id, line) AS r, doc_id, line,
         list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM words WHERE len(w) > 0),
classes AS (SELECT s, min(r) AS c, len(s) AS n FROM sets GROUP BY s),
tokens AS (SELECT c, n, unnest(s) AS t FROM classes),
near AS (
  SELECT DISTINCT b.c FROM tokens a JOIN tokens b ON a.t = b.t AND a.c < b.c
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
judged AS (
  SELECT doc_id, line, (r <> c OR c IN (SELECT c FROM near)) AS gone FROM sets JOIN classes USING (s)),
counts AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM judged GROUP BY 1),
texts AS (
  SELECT doc_id, string_agg(body, chr(10) ORDER BY line) FILTER (NOT coalesce(gone, false)) AS text
  FROM lines LEFT JOIN judged USING (doc_id, line) GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN texts t USING (doc_id)
"""
