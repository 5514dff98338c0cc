"""N-gram Jaccard join with a token-group matrix.

Documents are sets of five-word shingles; two link when 5 * intersection >= 4 * union. Exact copies
are one set from the start. The join works with *regions*: the shingles whose hash lies below a
threshold that falls with the set's size. If Q and S are similar, S lacks at most floor(|Q| / 5) of
Q's shingles, so of Q's shingles in the region at least (their number less that) are in S too,
whatever the region is. Nothing is lost, and only about a quarter of all shingles travel.

1. Coarse bound: a set stays only if enough of its region's shingles occur in any other set, then,
   of these, only if four fifths of all its shingles occur in others. Few sets of a corpus do. How
   many do also bounds what two sets can have in common.
2. Groups: those sets are partitioned by their smallest hashes; each is compared with the leader
   of its partition (a pair per set, not all pairs), and verified links join groups.
3. Token-group matrix: (shingle, group) for the union of each group. A set's overlap with a foreign
   group's union bounds its overlap with each member; groups below the bound stay shut. Only groups
   that hold one of the set's rarest shingles, at a place and with sizes that leave enough room for
   an overlap, are bounded at all (``prefixes``).
4. Open groups: the members that pass the same filters one by one are verified.

Links that step 2 skips lie within a group that is already connected, so components, the
result, are exact. Shingles that many sets hold are a list of bounded length and count as shared
without being shuffled in step 1.

Sets whose region is too small for the bound to say anything (a rare fluctuation) all stay in
step 1; others still count what those sets hold.

Defined results: null and empty texts have no set and are their own component. A component is
named by its smallest document id (null only if it has no other). Rows of equal id stay rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import components, drop_stored, likely_in, stored, table, unused
from tessera.llm.tokensets import (BLOB_ROWS, COUNTS, POSTINGS, TEXT_ROWS, Dealer, Frequency, Sets, alike, buckets_for,
                                   can_overlap, compatible, counts_dealt, frequent, gathered, is_in, missing,
                                   packed_texts, parts_for, posting_batch, shared_by_sets, signed, summed_counts,
                                   text_sets, unpacked_slices, verified, with_common)
from tessera.llm.words import mixed, slices

_U = np.uint64
_OWN_SPACE = _U(0x5851F42D4C957F2D)
_PROFILE = ("doc_id long, key struct<doc_id:bigint,hash:bigint>, id long, n long, low1 long, low2 long, low3 long, "
            "needed long, region long, tokens binary, counts binary")


def region_share(n: np.ndarray) -> np.ndarray:
    """Share of the hash space that a set of size ``n`` looks at; never rises with n."""
    n = np.maximum(n, 1).astype(float)
    return np.where(n < 64, 1.0, np.minimum(1.0, 0.22 + 2.0 / np.sqrt(n)))


def _limits(n: np.ndarray) -> np.ndarray:
    return np.minimum(region_share(n) * 2.0 ** 64, 2.0 ** 64 - 2048).astype(_U)


class Regions:
    """Which shingles of each set are asked for and which are held ready for others."""

    def __init__(self, sets: Sets):
        n, self.sets = sets.sizes, sets
        whole = n < 64
        self.asked = (sets.tokens < _limits(n)[sets.owner]) | whole[sets.owner]
        smaller = -(-4 * n // 5)  # the smallest set that can be similar looks furthest
        self.held = (sets.tokens < _limits(smaller)[sets.owner]) | (smaller < 64)[sets.owner]
        asked = np.bincount(sets.owner[self.asked], minlength=len(n))
        self.odd = (n > 0) & (asked <= missing(n))
        self.needed = asked - missing(n)  # 0 or less: odd, no count is asked for

    def postings(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shingle, set number, 1 if asked for)."""
        s = self.sets
        use = self.held if keep is None else self.held & keep
        asks = self.asked & ~self.odd[s.owner]
        return s.tokens[use], s.owner[use], asks[use].astype(np.uint8)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in _PROFILE.split(", ")]
    for batch in batches:
        often, rows = Frequency(), []
        for s in slices(batch.column(2)):
            sets = text_sets(s)
            regions = Regions(sets)
            often.add(sets.tokens[regions.held], len(sets))
            low = [sets.folded(x, np.minimum) for x in (sets.tokens, mixed(sets.tokens ^ _OWN_SPACE),
                                                        mixed(sets.tokens + _OWN_SPACE))]
            part = batch.slice(s.first, len(s))
            rows.append([part.column(0), part.column(1), signed(sets.ids()), pa.array(sets.sizes),
                         *map(signed, low), pa.array(regions.needed),
                         pa.array(np.bincount(sets.owner[regions.held], minlength=len(sets)))])
        tokens, counts = often.found()
        for i, columns in enumerate(rows):
            blobs = [[None] * len(columns[0]) for _ in range(2)]
            if i == 0 and len(columns[0]):  # the batch's frequent shingles ride on its first row
                blobs[0][0], blobs[1][0] = tokens.tobytes(), counts.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(b, pa.binary()) for b in blobs)], names=names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for t, n in zip(b.column(0), b.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t.as_py(), "<i8")),
                                              pa.array(np.frombuffer(n.as_py(), "<i8"))], names=["token", "n"])


def profile(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One narrow row per document; stored."""
    return stored(keyed(docs, doc_id, text).mapInArrow(_profile, _PROFILE), "profile", TEXT_ROWS)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, key, text."""
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), row_key(docs, doc_id, text).alias("key"),
                       docs[text].alias("text"))


def row_key(docs: DataFrame, doc_id: str, text: str) -> Column:
    """The id and a hash of the text: equal for equal rows only, even where ids repeat."""
    return F.struct(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("hash"))


def coarse(docs: DataFrame, sets: DataFrame, hot: np.ndarray, postings: int) -> DataFrame:
    """Ids of the sets that share enough of their region with any others, and of all odd sets."""
    buckets, parts = buckets_for(postings), parts_for(postings)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(buckets, short=True)
        for batch in batches:
            known = []
            for s in slices(batch.column(0)):
                found = text_sets(s)
                regions, ids = Regions(found), found.ids()
                often = is_in(found.tokens, hot)
                twins = alike(found.tokens, found.owner)  # taken to be shared: others only ask more sets in
                tokens, owner, asks = regions.postings(~(often | twins))
                yield from dealer.add(tokens, ids[owner], asks)
                asked = (often | twins) & regions.asked & ~regions.odd[found.owner]
                if asked.any():
                    n = np.bincount(found.owner[asked], minlength=len(found)).astype("<u8")
                    known.append((ids[n > 0], n[n > 0]))
            if known:  # shared for certain, or taken to be: counts by set, each batch a bucket of its own
                own, n = map(np.concatenate, zip(*known))
                yield posting_batch([(-1 - int(own[0] % _U(1 << 30)), n.tobytes(), own.tobytes(), b"")])
        yield from dealer.rest()

    def meet(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() < 0:
            n, ids = (np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in group.column(c)])
                      for c in ("tokens", "owners"))
            return counts_dealt(ids, n, parts, often=True)
        tokens, owners, extra = gathered(group, "<u1", "<u4")
        fresh, shared = shared_by_sets(tokens, owners)
        return counts_dealt(*np.unique(owners[fresh & shared & (extra == 1)], return_counts=True), parts)

    counts = docs.select("text").mapInArrow(emit, POSTINGS).groupBy("bucket").applyInArrow(meet, COUNTS)
    # Buckets report a set once; copies report the same count of frequent shingles each.
    total = summed_counts(counts, "c")
    enough = total.join(sets.where("needed > 0").select("id", "needed"), "id").where("c >= needed").select("id")
    return stored(enough.unionByName(sets.where("needed <= 0").select("id")), "coarse", TEXT_ROWS)


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, n, tokens of the wanted sets (id, key; stored), from their texts again; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(1).to_numpy(zero_copy_only=False)
            for at, s in unpacked_slices(batch.column(0)):
                found = text_sets(s)
                ids = found.ids().view(np.int64)
                own = np.flatnonzero(ids == asked[at + s.first: at + s.first + len(s)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[own]), pa.array(found.sizes[own]),
                     pa.array([found[i].tobytes() for i in own], pa.binary())],
                    names=["id", "n", "tokens"])

    texts = packed_texts(likely_in(docs.select("key", "text"), "key", wanted), "text")
    # Equal rows lie in one partition after the join, by the key of ``wanted``, and become one there.
    asked = wanted.select(F.col("key").alias("named"), "id")
    texts = texts.join(asked, F.col("key") == F.col("named")).select("named", "id", "text").distinct()
    return stored(texts.select("text", "id").mapInArrow(run, "id long, n long, tokens binary"), "sets", TEXT_ROWS)


def star_pairs(sets: DataFrame) -> DataFrame:
    """Each set with the leader of its partition, for three partitions by smallest hash.

    The leader is the set that shares the largest part of its shingles with others: in a family
    of edited copies the original, whose shingles all occur in some copy.
    """
    out = None
    for low in ("low1", "low2", "low3"):
        leader = sets.groupBy(low).agg(F.max(F.struct(F.col("common") / F.col("n"), "id", "n", "common")).alias("f"),
                                       F.count(F.lit(1)).alias("c")).where("c > 1")
        leader = leader.select(low, F.col("f.id").alias("b"), F.col("f.n").alias("m"), F.col("f.common").alias("d"))
        pairs = (sets.join(leader, low).where(f"id <> b and {can_overlap('common', 'n', 'd', 'm')}")
                 .select(F.col("id").alias("a"), "b"))
        out = pairs if out is None else out.union(pairs)
    return out


def families(sets: DataFrame) -> DataFrame:
    """id, leader: of the leaders of a set's three partitions, itself included, the one ``star_pairs`` ranks first.

    Leaders are followed to their own leaders, so that the partitions of one family meet.
    """
    rank = F.struct((F.col("common") / F.col("n")).alias("part"), "id")
    out = sets.select("id", "low1", "low2", "low3")
    for low in ("low1", "low2", "low3"):
        out = out.join(sets.groupBy(low).agg(F.max(rank).alias(f"best_{low}")), low)
    first = stored(out.select("id", F.greatest("best_low1", "best_low2", "best_low3")["id"].alias("leader")), "leaders")
    up = first.select(F.col("id").alias("leader"), F.col("leader").alias("up"))
    twice = first.join(up, "leader").select("id", F.col("up").alias("leader"))
    out = stored(twice.join(up, "leader").select("id", F.col("up").alias("leader")), "leaders")
    drop_stored(first)
    return out


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of stored sets (id, tokens) as rows: token, id."""
    for batch in batches:
        arrays = [np.frombuffer(x.as_py(), "<i8") for x in batch.column(1)]
        own = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in arrays])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])), pa.array(own)],
                                         names=["token", "id"])


def shingles(sets: DataFrame) -> DataFrame:
    """token, id of the sets."""
    return sets.select("id", "tokens").mapInArrow(_exploded, "token long, id long")


def _grouped(ids: DataFrame, links: DataFrame) -> DataFrame:
    """``ids`` with grp: the smallest id that each id reaches over the links."""
    found = components(links)
    return ids.join(found, "id", "left").select(*ids.columns, F.coalesce("component", "id").alias("grp"))


def prefixes(sets: DataFrame, info: DataFrame) -> DataFrame:
    """token, id, n, common, grp, place: the shingles among a set's rarest floor(n / 5) + 1 that other sets hold; stored.

    Rarity is the number of sets that hold a shingle. Similar sets of n and m shingles have their first common one, in
    this order, within both prefixes, and what they share lies at or behind it in both.
    """
    wide = shingles(sets).groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    of_set = Window.partitionBy("id")
    held = shingles(sets).join(wide, "token").withColumns(
        {"w": F.count(F.lit(1)).over(of_set), "rank": F.row_number().over(of_set.orderBy("c", "token"))})
    held = held.join(info, "id").withColumn("place", F.expr("n - w + rank")).where("place <= floor(n / 5) + 1")
    return stored(held.select("token", "id", "n", "common", "grp", "place"), "prefixes", BLOB_ROWS)


def opened_groups(sets: DataFrame, info: DataFrame, first: DataFrame) -> DataFrame:
    """id, other: the foreign groups whose union of shingles holds enough of a set's for a member to be similar; stored.

    Groups are found by the prefixes, with the length and positional filters on the ranges of their members, then
    bounded by the matrix: at least four fifths of the set must lie in the group's union.
    """
    of_group = first.groupBy("token", F.col("grp").alias("other")).agg(
        F.min("n").alias("m"), F.max("n").alias("most"), F.min("place").alias("at"), F.max("common").alias("d"))
    near = ("grp <> other and 5 * n >= 4 * m and 5 * most >= 4 * n and 9 * (1 + least(n - place, most - at)) >= 4 * (n + m)"
            f" and {can_overlap('common', 'n', 'd', 'm')}")
    met = stored(first.join(of_group, "token").where(near).select("id", "n", "other").distinct(), "met")
    members = stored(info.select("id", F.col("grp").alias("other"))
                     .join(met.select("other").distinct(), "other", "left_semi").select("id", "other"), "members")
    union = shingles(likely_in(sets, "id", members)).join(members, "id").select("token", "other").distinct()
    asking = shingles(likely_in(sets, "id", met))
    opened = (met.join(asking, "id").join(union, ["token", "other"]).groupBy("id", "n", "other")
              .agg(F.count(F.lit(1)).alias("c")).where("5 * c >= 4 * n"))
    opened = stored(opened.select("id", "other"), "opened", BLOB_ROWS)
    drop_stored(met, members)
    return opened


def likely_pairs(first: DataFrame, opened: DataFrame) -> DataFrame:
    """id, member: sets and members of the groups opened for them that pass the filters of a set-similarity join."""
    members = first.select("token", F.col("id").alias("member"), F.col("n").alias("m"), F.col("common").alias("d"),
                           F.col("grp").alias("other"), F.col("place").alias("at"))
    near = (f"grp <> other and {compatible('n', 'm')} and 9 * (1 + least(n - place, m - at)) >= 4 * (n + m)"
            f" and {can_overlap('common', 'n', 'd', 'm')}")
    asks = first.join(opened.select("id").distinct(), "id", "left_semi")
    asked = members.join(opened.select("other").distinct(), "other", "left_semi")
    pairs = asks.join(asked, "token").where(near).select("id", "member", "other").distinct()
    return pairs.join(opened, ["id", "other"], "left_semi").select("id", "member")


def matrix_groups(sets: DataFrame, links: DataFrame) -> DataFrame:
    """id, grp of all sets: the components of ``links`` joined by steps 3 and 4."""
    info = stored(_grouped(sets.select("id", "n", "common"), links), "groups")
    first = prefixes(sets, info)
    opened = opened_groups(sets, info, first)
    pairs = stored(likely_pairs(first, opened).select(F.least("id", "member").alias("a"),
                                                      F.greatest("id", "member").alias("b")).distinct(), "pairs")
    drop_stored(first, opened, info)
    named = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "named")
    found = verified(pairs, likely_in(sets, "id", named))
    drop_stored(pairs, named)
    return _grouped(sets.select("id"), links.unionByName(found))


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, id (of the set), n_shingles and component_id of each document."""
    rows = profile(docs, doc_id, text)
    known = rows.where("n > 0").groupBy("id").agg(
        F.min("doc_id").alias("smallest"), F.min("key").alias("key"),
        *[F.first(c).alias(c) for c in ("n", "low1", "low2", "low3", "needed", "region")])
    known = stored(known, "known")
    size = known.agg(F.sum("region").alias("postings"), F.count(F.lit(1)).alias("sets")).first()
    blobs = rows.where("tokens is not null").select("tokens", "counts")
    hot = frequent(blobs.mapInArrow(_counted, "token long, n long"), size["sets"])
    texts = keyed(docs, doc_id, text)
    kept = coarse(texts, known, hot, size["postings"] or 0)
    left = stored(known.join(kept, "id"), "left")
    drop_stored(kept)
    sets = with_common(fetched(texts, left.select("id", "key")), hot, "common")
    ranked = stored(sets.select("id", "n", "common").join(left.select("id", "low1", "low2", "low3"), "id"), "ranked")
    drop_stored(left)
    leaders = families(ranked)
    own = leaders.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    links = verified(star_pairs(ranked).union(own), sets)
    drop_stored(ranked)
    groups = stored(matrix_groups(sets, links), "groups")
    drop_stored(sets, leaders, links)
    groups = groups.withColumnRenamed("grp", "component")
    named = groups.join(known.select("id", "smallest"), "id").groupBy("component").agg(F.min("smallest").alias("name"))
    of_set = known.select("id", "smallest").join(groups, "id", "left").join(named, "component", "left").select(
        "id", F.coalesce("name", "smallest").alias("name"))
    return rows.join(of_set, "id", "left").select(
        "doc_id", "key", "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id; documents without shingles stay."""
    found = linked(docs, doc_id, text)
    with_set = found.where("n_shingles > 0")
    keep = with_set.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("id")).alias("i")).agg(
        F.min("key").alias("by_key"),
        F.min(F.when(F.col("doc_id") == F.col("component_id"), F.col("key"))).alias("by_id"))
    keep = keep.select(F.coalesce("by_id", "by_key").alias("key"))
    k, r = unused(docs, "key", "copy")
    held = docs.withColumn(k, row_key(docs, doc_id, text))
    empty = found.where("n_shingles = 0").select("key").distinct()
    names = keep.select(F.col("key").alias(k), F.lit(True).alias(r)).unionByName(
        empty.select(F.col("key").alias(k), F.lit(False).alias(r)))
    joined = held.join(names.distinct(), k)
    # Of equal rows of the kept document only one stays.
    twin = Window.partitionBy(k).orderBy(F.col(k))
    return (joined.withColumn(k, F.row_number().over(twin)).where(~F.col(r) | (F.col(k) == 1))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_token_group_join(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM words),
classes AS (SELECT s, min(r) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT c, n, unnest(s) AS t FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c <> b.c
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT c, c FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (
  SELECT reach.a AS c, min(sets.doc_id) AS component_id
  FROM reach JOIN classes ON classes.c = reach.b JOIN sets ON sets.s = classes.s GROUP BY 1)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(lowest.component_id, doc_id) AS component_id
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN lowest ON lowest.c = classes.c
"""
